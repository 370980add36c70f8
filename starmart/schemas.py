"""Source and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# ---- fixed values: field names of the five newline-delimited JSON sources ----

BUSINESS = _struct(
    business_id=TEXT, name=TEXT, address=TEXT, city=TEXT, state=TEXT, postal_code=TEXT,
    latitude=DOUBLE, longitude=DOUBLE, stars=DOUBLE, review_count=LONG, is_open=INT,
    # nested objects are kept as their JSON source text
    attributes=TEXT, categories=TEXT, hours=TEXT,
)

#: Text fields of the sources that hold JSON; they keep their source text.
SOURCE_TEXT = ["attributes", "hours"]

CHECKIN = _struct(business_id=TEXT, date=TEXT)

REVIEW = _struct(
    review_id=TEXT, user_id=TEXT, business_id=TEXT, stars=DOUBLE,
    useful=LONG, funny=LONG, cool=LONG, text=TEXT, date=TEXT,
)

TIP = _struct(user_id=TEXT, business_id=TEXT, text=TEXT, date=TEXT, compliment_count=LONG)

COMPLIMENTS = [
    "compliment_cool", "compliment_cute", "compliment_funny", "compliment_hot", "compliment_list",
    "compliment_more", "compliment_note", "compliment_photos", "compliment_plain",
    "compliment_profile", "compliment_writer",
]

USER = _struct(
    user_id=TEXT, name=TEXT, yelping_since=TEXT, review_count=LONG, average_stars=DOUBLE,
    fans=LONG, elite=TEXT, **{name: LONG for name in COMPLIMENTS},
)

SOURCES = {"business": BUSINESS, "review": REVIEW, "checkin": CHECKIN, "tip": TIP, "user": USER}

# ---- fixed values: table names and columns of the star schemas, one schema per audience ----

STAR_TABLES = {
    "manager/Dim_Date": "date_id string, date date, month int, year int, quarter int, is_weekend boolean",
    "manager/Dim_Location": "location_id string, business_id string, city string, state string, "
                            "postal_code string, latitude double, longitude double",
    "manager/Dim_Category": "category_id bigint, category_name string",
    "manager/Fact_Business_Categories": "business_id string, category_id bigint",
    "manager/Dim_Business": "business_id string, name string, subcategory string, is_open boolean, "
                            "overall_avg_rating decimal(3,1), overall_review_count bigint",
    "manager/Fact_Business_Performance": "business_id string, month_id string, review_count bigint, "
                                         "checkin_count bigint, tip_count bigint, photo_count int, "
                                         "engagement_score double, growth_rate double",
    "marketing/DimBusiness": "business_id string, name string, categories array<string>, city string, "
                             "state string, postal_code string, latitude double, longitude double, "
                             "is_open boolean, attributes_json string",
    "marketing/DimUser": "user_id string, name string, yelping_since date, review_count bigint, "
                         "average_stars double, fans bigint, elite_years array<string>, compliment_count bigint",
    "marketing/DimReview": "review_id string, review_text string",
    "marketing/DimDate": "date_id int, full_date date, day int, month int, quarter int, year int, "
                         "day_of_week string",
    "marketing/FactCustomerEngagement": "review_id string, user_id string, business_id string, date_id int, "
                                        "stars int, useful_votes bigint, funny_votes bigint, cool_votes bigint, "
                                        "tip_count bigint, checkin_count bigint",
    "marketing/BusinessCategoryBridge": "business_id string, category string",
    "investor/Dim_Location": "location_key bigint, city string, state string, postal_code string, "
                             "latitude double, longitude double",
    "investor/Dim_Category": "category_key bigint, category_name string",
    "investor/Dim_Date": "date_key int, full_date date, year int, month int, day int, day_of_week int, "
                         "day_name string, month_name string, quarter int, is_weekend boolean",
    "investor/Dim_Business": "business_key bigint, business_nk string, name string, address string, "
                             "location_key bigint, stars double, review_count bigint, is_open int",
    "investor/Fact_Business_Categories": "business_key bigint, category_key bigint",
    "investor/Fact_Business_Performance": "performance_key bigint, business_key bigint, date_key int, "
                                          "review_count bigint, average_stars double, checkin_count bigint",
    "operations/Dim_Date": "date_id string, date date, day_of_week string",
    "operations/Fact_Operational_Performance": "date_id string, business_id string, daily_reviews bigint, "
                                               "avg_daily_rating double, daily_checkins bigint, "
                                               "sentiment_score_avg double",
}
