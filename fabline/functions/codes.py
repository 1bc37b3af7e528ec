"""Fixed values of the production line.

These must equal the line's own settings for results to match; they are
stated here plainly, in natural order.
"""

# --- fixed values: message topics -----------------------------------------
TABLES_CONNECTION = "/tables/connection"

LOADING_READY_TO_NEW_MAT = "/loading/ReadyToNewMat"
LOADING_MAT_LOADED = "/loading/MatLoaded"
LOADING_MAT_POSITION = "/loading/MatPosition"
LOADING_MAT_DROPPED = "/loading/MatDropped"
LOADING_MAT_PROCESS = "/loading/MatProcess"
LOADING_RFID_READ_PROBLEM = "/loading/rfidReadProblem"
LOADING_WARNING = "/loading/warning"

ROLLING_MAT_POSITION = "/rolling/MatPosition"
ROLLING_ROLL_QUERY = "/rolling/RollQuery"
ROLLING_MAT_AFTER_ROLL = "/rolling/MatAfterRoll"
ROLLING_ROLL_THICKNESS = "/rolling/RollThickness"
ROLLING_WARNING = "/rolling/warning"
ROLLING_MOTOR_INFO = "/rolling/motorInfo"
ROLLING_CONTROL = "/rolling/control"

QUALITY_MAT_POSITION = "/quality/MatPosition"
QUALITY_MAT_READY_TO_QCHECK = "/quality/MatReadyToQCheck"
QUALITY_MAT_CHECK = "/quality/MatCheck"
QUALITY_WARNING = "/quality/warning"

COLOUR_MAT_CHECK = "/colourSensor/MatCheck"
COLOUR_MAT_READY_TO_QCHECK = "/colourSensor/MatReadyToQCheck"
COLOUR_WARNING = "/colourSensor/warning"
COLOUR_TRAIN_REAL = "/colourSensor/colourData"
COLOUR_TRAIN_SIMULATED = "fakeColorData"

UNLOADING_MAT_POSITION = "/unloading/MatPosition"
UNLOADING_MAT_FINAL = "/unloading/MatFinal"
UNLOADING_MAT_QUERY = "/unloading/MatQuery"
UNLOADING_MAT_DROP = "/unloading/MatDrop"
UNLOADING_WARNING = "/unloading/warning"

VIBRATION = "/vibrationSensor/vibration"

STATIONS = ["loading", "rolling", "quality", "unloading"]

# Log-only subscriptions of the controller: warnings and connection notes.
WARNING_TOPICS = [TABLES_CONNECTION, LOADING_RFID_READ_PROBLEM, LOADING_WARNING,
                  ROLLING_WARNING, QUALITY_WARNING, COLOUR_WARNING, UNLOADING_WARNING]

# --- fixed values: material allow-list (id -> roll thickness) -------------
ALLOW_LIST = [
    ("80795adb", "50"),
    ("d0715adb", "50"),
    ("40e35bdb", "50"),
    ("d0655adb", "50"),
    ("e02f5ddb", "50"),
    ("e0195adb", "50"),
    ("801e5adb", "50"),
]

# --- fixed values: sensor positions (station, index, label, coordinate) ---
# Coordinate of the first RFID read at loading: 7560.
FIRST_READ_COORDINATE = 7560
POSITIONS = [
    ("loading", 0, 4, 3780), ("loading", 1, 5, 5040), ("loading", 2, 10, 10080),
    ("loading", 3, 11, 11340), ("loading", 4, 13, 13230), ("loading", 5, 16, 15750),
    ("rolling", 0, 18, 17640), ("rolling", 1, 20, 19530), ("rolling", 2, 21, 21420),
    ("rolling", 3, 23, 23310), ("rolling", 4, 26, 26460), ("rolling", 5, 28, 27720),
    ("rolling", 6, 30, 29610), ("rolling", 7, 32, 31500),
    ("quality", 0, 33, 33390), ("quality", 1, 36, 35910), ("quality", 2, 38, 37800),
    ("quality", 3, 42, 41580), ("quality", 4, 43, 43470), ("quality", 5, 46, 45990),
    ("quality", 6, 48, 47880),
    ("unloading", 0, 50, 50400), ("unloading", 1, 52, 52290), ("unloading", 2, 54, 54180),
    ("unloading", 3, 57, 56700), ("unloading", 4, 59, 58590), ("unloading", 5, 60, 60480),
]

# --- fixed values: quality classes ----------------------------------------
GOOD, DEFECT1, DEFECT2 = "good", "defect1", "defect2"
CLASSES = [GOOD, DEFECT1, DEFECT2]
UNKNOWN_LABEL = "unknown"
NO_LABEL = "none"

# --- fixed values: vibration conversion -----------------------------------
G_CONST = 9.813
LSB_VAL = 4
LSB16_TO_KILO_LSB10 = 64000
Z_OFFSET = 10.0

# --- fixed values: colour sensor clamp ranges (low, high) -----------------
RED_RANGE = (100, 1300)
GREEN_RANGE = (190, 1300)
BLUE_RANGE = (250, 1200)

# --- fixed values: thresholds and intervals (defaults of the operators) ---
WINDOW_MS = 3000
DELTA_THRESHOLD = 0.6
VIBRATION_LIMIT = 0.3            # stall level; the streak change limit is half of it
ALARM_STREAK = 1                 # alarm when the streak exceeds this
COOLDOWN_S = 10
EXPORT_BATCH = 50
MIN_SETS_FOR_ML = 150
KNN_K = 5
DEBOUNCE_MS = 200
EXPORT_POLL_MS = 3000
STATS_INTERVAL_MIN = 1
RECENT_RANGE_MIN = 1
