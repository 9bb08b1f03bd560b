"""Fixed values that results depend on."""

# --- fixed values: class catalogue -----------------------------------------
OFFICIAL_CLASSES = {
    0: "can",
    1: "watermelon_rind",
    2: "meal_box",
    3: "red_paper_bag",
    4: "blue_bin",
    5: "green_bin",
    6: "red_bin",
    7: "purple_paper_bag",
    8: "sand_bottle",
}
DEFAULT_ROSTER_CLASSES = (0, 1, 2, 3)
BIN_CLASSES = (4, 5, 6)

# scene-name prefix -> class, first match wins
SCENE_CLASS_PREFIXES = (
    ("watermelon_rind", "watermelon_rind"),
    ("red_paper_bag", "red_paper_bag"),
    ("meal_box", "meal_box"),
    ("yellow_can", "can"),
    ("can", "can"),
    ("blue_bin", "blue_bin"),
    ("green_bin", "green_bin"),
    ("red_bin", "red_bin"),
)

# --- fixed values: statuses and splits -------------------------------------
STATUSES = ("accepted", "review", "rejected")
SPLITS = ("train", "val", "test")
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "bmp", "webp")

# --- fixed values: quality thresholds --------------------------------------
POSE_THRESHOLDS = {
    "min_mask_area": 80.0,
    "min_area_fraction": 0.00015,
    "max_area_fraction": 0.65,
    "min_depth_coverage": 0.45,
    "max_depth_median_abs_m": 0.05,
    "max_depth_rmse_m": 0.08,
    "min_area_ratio": 0.45,
    "max_area_ratio": 2.20,
    "max_center_shift_norm": 0.35,
    "max_translation_jump_m": 0.20,
    "max_rotation_jump_deg": 55.0,
    "min_dominant_component_ratio": 0.75,
    "border_margin_px": 2.0,
    "review_depth_coverage": 0.60,
    "review_depth_median_abs_m": 0.035,
    "review_center_shift_norm": 0.22,
    "review_translation_jump_m": 0.12,
    "review_rotation_jump_deg": 35.0,
}
# profile of plain mask sequences: no pose and no rendered depth
MASK_SEQUENCE_THRESHOLDS = {
    **POSE_THRESHOLDS,
    "min_mask_area": 80.0,
    "min_depth_coverage": 0.25,
    "max_depth_median_abs_m": 1e9,
    "max_depth_rmse_m": 1e9,
    "min_area_ratio": 0.35,
    "max_area_ratio": 2.8,
    "max_center_shift_norm": 0.40,
    "max_translation_jump_m": 1e9,
    "max_rotation_jump_deg": 1e9,
    "min_dominant_component_ratio": 0.70,
}

# --- fixed values: teacher detectors ---------------------------------------
TEACHER_MAPPING = {
    "yellow_can": "can",
    "watermelon_rind": "watermelon_rind",
    "eco_meal_box": "meal_box",
    "red_paper_bag": "red_paper_bag",
    "blue_trash_bin": "blue_bin",
    "green_trash_bin": "green_bin",
    "red_trash_bin": "red_bin",
    "purple_paper_bag": "purple_paper_bag",
}
TEACHER_HARD_NEGATIVES = (
    "plastic_bottle",
    "dry_leaf",
    "non_target_can",
    "non_target_bottle",
    "non_target_container",
    "colored_wrapper",
    "non_target_bag",
)
TEACHER_DETECTORS = (
    ("robot_objects", True, ("can", "watermelon_rind", "meal_box", "red_paper_bag", "purple_paper_bag")),
    ("trash_bins", True, ("blue_bin", "green_bin", "red_bin")),
    ("unified_crosscheck", False, ()),
)

# --- fixed values: training metrics ----------------------------------------
EPOCH_METRICS = ("precision_m", "recall_m", "map50_m", "map50_95_m", "map50_95_b")
TARGET_FPS = 20.0

# --- fixed values: project layout ------------------------------------------
PROJECT_DIRECTORIES = ("data", "datasets", "manifests", "assets", "reports")
REPOSITORY_DIRECTORIES = ("models", "third_party")
