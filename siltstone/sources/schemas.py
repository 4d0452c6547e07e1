"""Schemas of the inputs. Missing fields become null."""

REVIEW = (
    "review_id string, user_id string, business_id string, date string, stars double, text string"
)
BUSINESS = "business_id string, categories string, city string"
BUSINESS_EVENT = "city string, ts timestamp"
TWEET = (
    "id bigint, ts timestamp, lang string, text string, "
    "entities struct<hashtags: array<struct<text: string>>>"
)
