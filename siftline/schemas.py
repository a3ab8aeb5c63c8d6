"""One schema for each table."""

DOMAIN_LIST = "line_no int, value string"
SOURCE_RECORD = "source string, label int, url string, domain string, raw_value string, line_no int, phish_id string, target string, submission_time string, verification_time string, rank int, collected_at string"
RAW_HTML = "url string, html string, fetched_at string, method string, status_code int, error string, source string, _mojibake_fixed boolean"
PAGE_TEXT = "url string, source string, title string, meta_description string, text string, text_length int, forms_count int, has_password_field boolean, external_links array<string>, links_to_domains array<string>, method string, fetched_at string, error string"
BRAND = "category string, name string, official_domains array<string>, aliases array<string>, sector string"
SEED = "record_id string, url string, final_url string, domain string, label int, source string, source_ref string, html_path string, screenshot_path string, observed_at string, evidence array<string>"
