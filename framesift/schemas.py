"""Table schemas (DDL); one constant per table."""

MANIFESTS = (
    "manifest_path string, scene_id string, scene string, split string, file_split string, capture_session_id string, "
    "source_video_id string, name_prefix string, quality map<string,double>, mask_quality map<string,double>, "
    "max_instance_overlap double, include_review boolean, keep_conflicts boolean, allow_val_fallback boolean, "
    "instances array<struct<instance_id:string,class_id:int,class_name:string,tracker:string,start:int,max_frames:int,"
    "key_mask_dir:string,registration_mask_dir:string,mask_dir:string,quality:map<string,double>>>"
)
FRAMES = "scene_id string, frame_id string, color_timestamp_ms double, depth_timestamp_ms double, sensor_depth_scale double, valid_depth_ratio double"
DEPTH_ROWS = "scene_id string, frame_id string, y int, depth_mm array<int>"
MASK_RUNS = "scene_id string, frame_id string, instance_id string, y int, x_start int, x_end int"
POSES = "scene_id string, frame_id string, instance_id string, pose array<double>"
FRAME_VECTORS = "scene_id string, frame_id string, vec array<float>"
SEGMENTS = (
    "scene_id string, segment_id string, list_pos int, start_index int, end_index int, start_id string, end_id string, "
    "frame_count int, boundary_reasons array<string>, missing_key_masks array<string>, ready boolean"
)
QUALITY = (
    "scene_id string, instance_id string, frame_id string, output_id string, status string, auto_status string, "
    "manual_status string, manual_reason string, reject_reasons array<string>, review_reasons array<string>, has_label boolean, "
    "metrics struct<mask_area:bigint,area_fraction:double,depth_coverage:double,depth_valid_pixels:bigint,"
    "depth_median_abs_m:double,depth_rmse_m:double,connected_components:bigint,dominant_component_ratio:double,"
    "area_ratio:double,center_shift_norm:double,translation_jump_m:double,rotation_jump_deg:double,touches_border:boolean>"
)
OVERRIDES = "scene_id string, instance_id string, frame_id string, status string, reason string, updated_at string"
REPORTS = (
    "report_path string, scene string, split string, capture_session_id string, source_video_id string, "
    "frame_status_counts map<string,int>, instances array<struct<instance_id:string,class_id:int,class_name:string,stage:string,tracker:string>>, "
    "frames array<struct<output_id:string,status:string>>"
)
LABEL_LINES = "split string, stem string, line_no int, line string"
FILES = "split string, kind string, stem string, suffix string, path string, size bigint, sha256 string"
NEGATIVES = "split string, image string, stem string, capture_session_id string, source_video_id string"
DETECTIONS = "scene_id string, frame_id string, detector string, det_index int, source_class string, confidence double, bbox_xyxy array<double>"
EPOCHS = "run string, row_no int, epoch int, precision_m double, recall_m double, map50_m double, map50_95_m double, map50_95_b double"
FRAME_EVENTS = (
    "scene_id string, seq bigint, ts timestamp, width int, height int, "
    "intrinsics struct<fx:double,fy:double,cx:double,cy:double>, rgb binary, depth binary"
)
RANGES = "scene_id string, instance_id string, segment_id string, start_frame string, end_before_frame string"
CLASSES = "class_id int, class_name string, display_name string, role string"
VIOLATIONS = "rule string, key string, detail string"
