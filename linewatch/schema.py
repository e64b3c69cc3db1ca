"""Column names and schemas of the sensor domain."""

from __future__ import annotations

from pyspark.sql import types as T

ROW_ID = "row_id"
# Fixed value: the row counter as publishers of the raw table send it.
SENT_ROW_ID = "Unnamed: 0"

# Sensor columns of the raw table.
SENSORS = [
    "Hydraulic_Pressure(bar)",
    "Coolant_Pressure(bar)",
    "Torque(Nm)",
    "Spindle_Speed(RPM)",
    "Voltage(volts)",
    "Coolant_Temperature",
    "Air_System_Pressure(bar)",
    "Hydraulic_Oil_Temperature(?C)",
    "Spindle_Bearing_Temperature(?C)",
    "Spindle_Vibration(?m)",
    "Tool_Vibration(?m)",
    "Cutting(kN)",
]

CATEGORIES = ["Machine_ID", "Assembly_Line_No"]
GROUP = "Downtime_Group"
TARGET = "Future_Downtime_Label"
LABEL_COLUMNS = ["Downtime", GROUP, TARGET]

# Which downtime reason belongs to which group.
DOWNTIME_GROUPS = {
    "Machine_Issue": [
        "Sensor_Fault",
        "Overheating",
        "Tool_Wear",
        "Machine_Failure",
        "Unplanned_Stop",
    ],
    "Operations": [
        "Operator_Error",
        "Maintenance",
        "Scheduled_Inspection",
        "Planned_Stop",
        "Quality_Check",
        "Material_Shortage",
    ],
    "Infrastructure": ["Network_Issue", "Power_Failure", "Software_Glitch"],
    "Normal": ["No_Machine_Failure"],
}
UNKNOWN = "Unknown"


def raw_schema(sensors: list[str] | None = None, with_row_id: bool = True) -> T.StructType:
    """Every raw column arrives as text and is coerced later, so that one bad
    value costs that value and not its row."""
    names = ["Date", "Timestamp", *CATEGORIES, *(SENSORS if sensors is None else sensors), "Downtime"]
    fields = [T.StructField(n, T.StringType()) for n in names]
    if with_row_id:
        fields.insert(0, T.StructField(ROW_ID, T.LongType()))
    return T.StructType(fields)


def quoted(name: str) -> str:
    """A column reference for a name that may hold dots, brackets or backticks."""
    return "`" + name.replace("`", "``") + "`"
