"""Explicit schemas of the canonical tables; nothing is inferred from data."""

MESSAGE = "struct<role:string,content:string>"
ANNOTATION = "id string, image string, conversations array<struct<from:string,value:string>>"
VIDEO_ANNOTATION = "q string, a string, video_id string"
SFT = f"id string, source string, media_type string, messages array<{MESSAGE}>, images array<string>, videos array<string>, media array<string>"
DPO = f"messages array<{MESSAGE}>, chosen {MESSAGE}, rejected {MESSAGE}, images array<string>, source string, assumption string"
RLVR = "problem string, answer string, images array<binary>"
METRICS = "ts double, iso timestamp_ntz, total_mb double, anon_mb double, file_mb double, slab_mb double, gpu_mem_max_mb double, gpu_util_avg double, gpu_idle_count int, step int, loss double, grad_norm double, lr double, epoch double, total_steps int"
TRAINER_LINE = "current_steps long, global_step long, total_steps long, loss double, lr double, learning_rate double, epoch double, percentage double, elapsed_time string, remaining_time string"
RESULTS = "model string, bench string, score double, delta_vs_base double, detail string, judging string, source_file string"
