"""Table schemas of the feedback data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names and types of a review table.
REVIEW_COLUMNS = (
    "product_id", "product_name", "category", "discounted_price", "actual_price",
    "discount_percentage", "rating", "rating_count", "about_product", "user_id",
    "user_name", "review_id", "review_title", "review_content", "img_link", "product_link",
)

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name == "rating" else T.StringType())
        for name in REVIEW_COLUMNS
    ]
)

#: Same columns with every cell kept as text, so bad cells survive until cleaned.
RAW_REVIEW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in REVIEW_COLUMNS])

ITEMS_TYPE = "array<struct<text:string,cnt:bigint>>"

VALIDATION_TYPE = (
    "struct<total_rows:bigint,valid_rows:bigint,invalid_rows:bigint,"
    "quality_score:double,validation_issues:map<string,bigint>>"
)
SENTIMENT_TYPE = (
    "struct<counts:map<string,bigint>,average_scores:map<string,double>,"
    "dominant_sentiment:string,total_analyzed:bigint>"
)
ENTITIES_TYPE = (
    f"struct<counts_by_type:map<string,bigint>,top_entities_by_type:map<string,{ITEMS_TYPE}>>"
)
NLP_TYPE = (
    "struct<language:string,total_documents:bigint,skipped:boolean,"
    f"sentiment:{SENTIMENT_TYPE},entities:{ENTITIES_TYPE},key_phrases:{ITEMS_TYPE}>"
)
SCORES_TYPE = "struct<Positive:double,Negative:double,Neutral:double,Mixed:double>"
