"""Mini CSV inputs of FIXTURES §3 (report files, one bus line snapshot, stops)."""

from __future__ import annotations

import csv
import os

from routekpi.schemas import BUS_LINE_COLUMNS, STOPS_COLUMNS, YEARLINE_COLUMNS

# route code, year, boardings, revenue h, service h, peak load factor, utilization, pct, on-time
PERF_2023 = [
    ("005/006", 2019, "1000", "100", "120", "0.9", "0.5", "4.9", "80"),
    ("005/006", 2022, "700", "90", "110", "1.0", "0.55", "15", "78"),
    ("005/006", 2023, "800", "95", "115", "1.2", "0.6", "20", "82"),
    ("010", 2019, "0", "10", "0", "0.1", "0.05", "0", "90"),
    ("049", 2019, "600", "80", "100", "N/A", "0.4", "N/A", "85"),
    ("099", 2019, "200", "20", "25", "0.8", "0.45", "12", "88"),
]
PERF_2024 = [
    ("005/006", 2022, "705", "90", "110", "1.0", "0.55", "15", "78"),
    ("005/006", 2023, "805", "95", "115", "1.2", "0.6", "20", "82"),
    ("005/006", 2024, "905", "98", "118", "1.8", "0.7", "30", "84"),
    ("R4", 2023, "400", "50", "60", "1.1", "0.8", "5", "70"),
    ("R4", 2024, "500", "60", "70", "1.3", "0.9", "11.2", "72"),
    ("010", 2022, "30", "12", "15", "0.2", "0.1", "1", "91"),
    ("099", 2024, "250", "22", "27", "0.9", "1.2", "14.99", "86"),
]
# line, name, sub-region text, vehicle, service type, population
LINES_2024 = [
    ("005", "Main St", "Vancouver", "Diesel", "Local", "1,234"),
    ("R4", "41st Ave", "Vancouver/UBC", "", "RapidBus", "2,000 people"),
    ("049", "  ", "UBC", "Trolley", "Local", ""),
    ("010", "Lonsdale", "North Shore", "Diesel", "Local", "N/A"),
    ("SeaBus", "SeaBus", "North Shore", "Ferry", "Ferry", "0"),
]
STOPS = [
    ("S1", "101", "Main & 1st", "", "49.25", "-123.1", "Z1", "", "0", "", "1", ""),
    ("S2", "102", "Station", "", "49.26", "-123.0", "Z1", "", "1", "", "1", ""),
    ("S3", "103", "Far away", "", "51.0", "-123.0", "Z1", "", "0", "", "1", ""),
    ("S4", "x", "Odd type", "", "49.0", "-122.0", "Z2", "", "x", "", "", ""),
]


def yearline_row(code, year, b, rev, svc, plf, util, pct, ontime):
    row = {c: "" for c in YEARLINE_COLUMNS}
    row.update({
        "CalendarYear": str(year), "Lineno_renamed": code, "AnnualBoardings": b,
        "Annual_Revenue_Hours": rev, "Annual_Service_Hours": svc, "Average_Peak_Load_Factor": plf,
        "Average_Capacity_Utilization": util, "Perc_Trips_w_Overcrowding": pct,
        "On_Time_Performance_Percentage": ontime, "AVG_speed_km_per_hr": "NULL",
    })
    return [row[c] for c in YEARLINE_COLUMNS]


def line_row(line, name, sub, vehicle, service, population):
    row = {c: "" for c in BUS_LINE_COLUMNS}
    row.update({
        "Line": line, "Line_Name": name, "Sub_Region_of_Primary_Service": sub,
        "Predominant_Vehicle_Type": vehicle, "TSG_Service_Type": service, "Population": population,
        "AVG_speed_km_per_hr": "18 km/h", "Annual_Service_Cost": "$1,000.50", "TSPR_Year": "2024",
    })
    return [row[c] for c in BUS_LINE_COLUMNS]


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def write_inputs(root: str, perf_2023=PERF_2023, perf_2024=PERF_2024, lines=LINES_2024, stops=STOPS,
                 extra_yearline=()):
    _write(f"{root}/tspr_bus_yearline_2023.csv", YEARLINE_COLUMNS, [yearline_row(*r) for r in perf_2023])
    _write(f"{root}/tspr_bus_yearline_2024.csv", YEARLINE_COLUMNS,
           [yearline_row(*r) for r in perf_2024] + [yearline_row(*r) for r in extra_yearline])
    _write(f"{root}/TSPR_OpenData_Archive_2024.csv", BUS_LINE_COLUMNS, [line_row(*r) for r in lines])
    if stops is not None:
        _write(f"{root}/gtfs/stops.csv", STOPS_COLUMNS, stops)
    return root
