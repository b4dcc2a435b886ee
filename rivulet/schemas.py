"""Record schemas (one StructType per record type; never inferred on a stream)."""

from pyspark.sql import types as T

PURCHASE = T.StructType([
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("credit_card_number", T.StringType()),
    T.StructField("item_purchased", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("employee_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("purchase_date", T.TimestampNTZType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("store_id", T.StringType()),
])

PURCHASE_PATTERN = T.StructType([
    T.StructField("zip_code", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("amount", T.DoubleType()),
])

REWARD = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("purchase_total", T.DoubleType()),
    T.StructField("total_reward_points", T.IntegerType()),
    T.StructField("current_reward_points", T.IntegerType()),
    T.StructField("days_from_last_purchase", T.IntegerType()),
])

CORRELATED_PURCHASE = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("items_purchased", T.ArrayType(T.StringType())),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("first_purchase_time", T.TimestampNTZType()),
    T.StructField("second_purchase_time", T.TimestampNTZType()),
])

BEER_PURCHASE = T.StructType([
    T.StructField("currency", T.StringType()),
    T.StructField("total_sale", T.DoubleType()),
    T.StructField("number_cases", T.IntegerType()),
    T.StructField("beer_type", T.StringType()),
])

TRADE = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("shares", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
])

TICKER = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])

PROPS = T.StructType([T.StructField("k", T.IntegerType())])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
