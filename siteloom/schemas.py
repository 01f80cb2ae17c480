"""Schemas of the tables that the pipeline keeps."""

RESULT = (
    "url_hash string not null, created_at timestamp_ntz, trimmed_page_url string, site string, page_url string, business_category string, "
    "content_topic string, prediction_confidence double, review_flag boolean, nlp_raw_categories string, client_id string, "
    "last_accessed timestamp_ntz, view_count bigint"
)
RESULT_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]
STAGED_COLUMNS = ["url_hash", "trimmed_page_url", "site", "page_url", "client_id", "access_hits", "run_id", "batch_id"]
CATEGORIES = "array<struct<name:string,confidence:double>>"
