"""Table schemas, as DDL strings."""

KEYS = "run string, sub_run string, file_num int, feu int"
EVENTS = f"{KEYS}, entry bigint, eventId bigint, timestamp bigint, ftst int, sample array<int>, channel array<int>, amplitude array<int>"
PEDESTALS = "run string, sub_run string, feu int, channel int, mean double, rms double, rms_gate double"
MEASURES = (
    "channel int, pulse_idx int, amplitude double, time double, time_of_max double, sample double, max_sample double, "
    "local_baseline double, local_max double, left_sample double, right_sample double, time_over_threshold double, "
    "integral double, significance double, saturated boolean, trunc_left boolean, trunc_right boolean"
)
HITS = f"{KEYS}, entry bigint, eventId bigint, trigger_timestamp_ns bigint, {MEASURES}"
STRIP_MAP = "channel int, axis string, stripNumber int, pitch double, interpitch double, x double, y double, neighbours array<int>"
