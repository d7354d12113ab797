"""Fixed values that results depend on: names, patterns and default numbers."""

# Position in each list is the category id.
INSTRUMENTS = ("audusd", "eurusd", "usdjpy")
COLUMNS = ("open", "close", "high", "low", "volume")
CLASSES = ("bird",)

# Header names of a bar file, and where a labelling job keeps its manifests.
BAR_COLUMNS = ("Gmt time", "Open", "High", "Low", "Close", "Volume")
MANIFEST_PATH = "{root}/ground_truth_output/{label}/manifests/output/{kind}.manifest"

# Text formats of bar times and of feature start times.
BAR_TIME_PATTERN = "dd.MM.yyyy HH:mm:ss.SSS"
BAR_ZONE_SUFFIX = "+0000"
BAR_ZONE_PATTERN = "Z"
START_PATTERN = "yyyy-MM-dd HH:mm:ss"

# Multipliers that turn price changes into model units.
DEFAULT_SCALE = 1000.0
INSTRUMENT_SCALE = {"usdjpy": 10.0}

# Defaults of the jobs.
TRAIN_FRACTION = 0.8
SCORE_THRESHOLD = 0.6
MAX_IMAGE_BYTES = 800_000
MIN_HOLDOUT_FILE_BYTES = 100
MAX_REQUESTS = 5
NUM_SAMPLES = 100
QUANTILES = ("0.1", "0.2", "0.3", "0.4", "0.5", "0.6", "0.7", "0.8", "0.9")
IOU_THRESHOLD = 0.5
