"""Schemas of landed catalogue files and of the derived tables.

Nothing is inferred at run time. Fields not named here are dropped, unless the reader is
asked to keep records whole beside them (``files.read_catalog(extras=...)``). The names are
fixed values: they are those of the landed files.
"""

from __future__ import annotations

CATEGORY = (
    "struct<category_id:bigint,name_en:string,name_kh:string,slug:string,"
    "abbreviation:string,deleted_at:string>"
)
ORGANIZATION = (
    "struct<organization_id:bigint,name_en:string,name_kh:string,abbreviation:string,"
    "file_url:string,format:string,is_active:boolean,deleted_at:string>"
)
CATALOG = (
    "id string, slug string, uuid string, name string, title_en string, title_kh string, "
    "description string, description_en string, description_kh string, format string, "
    "file_url string, file_size string, organization_id bigint, dashboard_id string, "
    "column_data_id bigint, created_at string, updated_at string, coverage_start string, "
    "coverage_end string, frequency string, views_count bigint, download_count bigint, "
    "api_calls_count bigint, is_active boolean, source string, deleted_at string, "
    f"categories array<{CATEGORY}>, organization {ORGANIZATION}"
)
COLUMN = (
    "struct<title:string,type:string,format:string,description:string,"
    "reference_id:string,reference_field:string>"
)
COLUMN_METADATA = (
    "id string, name string, format string, column_data_id bigint, "
    f"columns array<{COLUMN}>, error string"
)
FILE = "struct<id:string,name:string,format:string,url:string,size:string>"
FILE_INFO = f"files array<{FILE}>"
DATA_INDEX = (
    f"id string, method string, files array<{FILE}>, json_row_count bigint, "
    "title_en string, title_kh string, category string, organization string"
)
VECTOR_PAYLOAD = (
    "struct<dataset_id:string,name:string,category:string,org:string,frequency:string,"
    "coverage_start:string,coverage_end:string>"
)
VECTORS = f"id string, vector array<float>, payload {VECTOR_PAYLOAD}"

# Latest-snapshot feeds: required fields first, free payload as JSON text.
EXCHANGE_RATE = (
    "id bigint, valid_date date, created_at timestamp, currency_id string, data string"
)
PROVINCE_READING = (
    "id bigint, name string, created_at timestamp, last_updated timestamp, data string"
)
INDEX_SNAPSHOT = (
    "id bigint, created_at timestamp, date string, value double, change double, "
    "change_percent double, change_up_down string, index_time string, opening double, "
    "high double, low double, trading_volume string, trading_value string, market_cap double"
)
STOCK_SUMMARY = (
    "id bigint, name string, created_at timestamp, icode string, dividend double, "
    "stock string, close string, change_up_down string, change double, open_price string, "
    "high string, low string, volume string, value string, pe string, pb string"
)
ARTICLES = (
    "id string, slug string, title_en string, title_kh string, summary_en string, "
    "summary_kh string, category string, event_date string, thumbnail string, "
    "created_at string, updated_at string"
)
ARTICLE_DETAIL = (
    ARTICLES + ", body_en string, body_kh string, images array<string>, tags array<string>"
)
SUBMISSION = "first_name string, last_name string, email string, phone string, message string"

REQUIRED = {
    "exchange_rate": ["id", "valid_date", "created_at", "currency_id", "data"],
    "province_reading": ["id", "name", "created_at", "last_updated", "data"],
    "index_snapshot": ["id", "created_at"],
    "stock_summary": ["id", "name", "created_at"],
}

# Domains of keys and options.
CURRENCIES = [
    "AUD", "CAD", "CHF", "CNH", "CNY", "EUR", "GBP", "HKD", "IDR", "INR", "JPY", "KRW",
    "LAK", "MMK", "MYR", "NZD", "PHP", "SDR", "SEK", "SGD", "THB", "TWD", "VND", "USD",
]
PROVINCES = [
    "Phnom Penh", "Sihanoukville", "Siem Reap", "Battambang", "Takeo", "Koh Kong", "Kratie",
    "Kampot", "Kep", "Kampong Thom", "Svay Rieng", "Mondulkiri", "Banteay Meanchey", "Kandal",
    "Prey Veng", "Kampong Chhnang", "Strung Treng", "Preah Vihear", "Tboung Khmum", "Pailin",
    "Ratanakiri", "Kampong Speu", "Kampong Cham", "Oddar Meanchey", "Pursat",
]
ARTICLE_CATEGORIES = ["blog", "events_and_news"]
ARTICLE_SORTS = ["title_en", "title_kh", "created_at", "updated_at", "event_date"]
