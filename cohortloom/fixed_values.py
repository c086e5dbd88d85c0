"""Fixed values of the data model. They must stay as they are for results to be right."""

# Lesion classes, in table order.
CLASSES = ["iph", "eah", "oedema", "ivh"]

# Classes kept in the model table.
MODEL_CLASSES = ["iph", "eah", "ivh"]

# Brain regions. The spelling of the left lentiform nucleus differs from the right on purpose.
REGIONS = [
    "BrainStem", "Cerebellum",
    "LeftBasalForebrain", "LeftBasalGanglia", "LeftBasalganglia-lentiform-nucleus", "LeftCaudate",
    "LeftCerebellum", "LeftFrontalLobe-inferior-orbital", "LeftFrontalLobe-lateral", "LeftFrontalLobe-medial",
    "LeftHippocampus", "LeftInsula", "LeftOccipitalLobe", "LeftParietalLobe", "LeftTemporalLobe",
    "LeftThalamusProper",
    "RightBasalForebrain", "RightBasalGanglia", "RightBasalGanglia-lentiform-nucleus", "RightCaudate",
    "RightCerebellum", "RightFrontalLobe-inferior-orbital", "RightFrontalLobe-lateral", "RightFrontalLobe-medial",
    "RightHippocampus", "RightInsula", "RightOccipitalLobe", "RightParietalLobe", "RightTemporalLobe",
    "RightThalamusProper",
    "Ventricle",
]

# Column name templates of the two wide families.
CLASS_REGION = "prediction_{cls}_{region}_ml"
REGION_VOLUME = "{region}_volume_ml"

# Words that mark a series as not an axial brain series.
NOT_BRAIN_WORDS = ["coronal", "sag", "chest", "abdomen", "spine", "facial_bones", "lung"]

# Words that mark an unusable image, and words that mark a corrected one.
UNUSABLE_IMAGE_WORDS = ["bone", "petro", "h60s"]
CORRECTED_IMAGE_WORDS = ["tilt", "_Eq"]

# Window limits, slice limits, time window and batch size.
MAX_WINDOW_CENTER, MAX_WINDOW_WIDTH = 100, 400
MIN_SLICES, MAX_SLICES = 30, 100
WINDOW_HOURS = 72
BATCH_ROWS = 1000

# Cuts of the review lists in ml: volume of a case, growth of either class, tails, very large volume.
CASE_ML, IPH_GROWTH_ML, EAH_GROWTH_ML, TAIL_ML, LARGE_ML = 5, 8, 9, 10, 100

# Labels of the quality tables.
STATUS_IPH, STATUS_EAH, STATUS_OUT, STATUS_OTHER = "IPH", "EAH", "-Exclude", "Unknown"

# Volume on the first scan for inclusion, outcome cuts, test share, seeds.
FIRST_SCAN_ML = 2
OUTCOME_CUTS = [6, 8, 10]
TEST_SHARE = 0.3
SPLIT_SEED, SAMPLE_SEED = 1300, 1148
