"""CSV reading goldens (FIXTURES §2) and the file-path label."""

from routekpi.sources.csv_raw import read_raw_csv

CSV = 'a,b,c\n1,"a ""q"" b",N/A\n3\n4,x,NULL,extra\n5," sp ","line1\nline2"\n6,null,""\n'


def test_positional_csv_goldens(spark, scratch):
    path = f"{scratch}/raw_2023.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write(CSV)
    rows = read_raw_csv(spark, path, ["a", "b", "c"], source_col="src", multiline=True).collect()
    got = {r.a: (r.b, r.c, r.src) for r in rows}
    assert got == {
        "1": ('a "q" b', None, "2023"),
        "3": (None, None, "2023"),
        "4": ("x", None, "2023"),
        "5": (" sp ", "line1\nline2", "2023"),
        "6": ("null", None, "2023"),
    }


def test_header_is_skipped_not_matched(spark, scratch):
    path = f"{scratch}/other_2024.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("z,y,x\n1,2,3\n")
    rows = read_raw_csv(spark, path, ["a", "b", "c"], multiline=False).collect()
    assert [tuple(r) for r in rows] == [("1", "2", "3")]
