"""Column layouts shared by all modules."""

SEARCH_LOG = (
    "date string, model string, best_params map<string,string>, best_score double, "
    "dataset_info struct<n_samples:bigint,dataset_name_and_type:string>"
)
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)

# Fixed values of the pipeline.
HORIZON = 52            # rows held out, and steps forecast
MIN_ROWS = 156          # shortest series accepted by the data gate
MISSING_SENTINEL = -9999.0
JITTER = 1e-8
