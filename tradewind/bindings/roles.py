"""The driver's tables in the roles of the commerce tables.

`Roles` gives typed tables, `Dirty` raw text tables whose faults come from
expressions over the keys. Both always cover whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns of the driver's tables; declared, so that opening a
# table does not start a job to look at its files.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


class Roles:
    """Typed tables read from one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("c_nationkey").alias("customer_state"),
        )

    @property
    def sellers(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("seller_id"), F.col("s_nationkey").alias("seller_state")
        )

    def products(self, category: str = "p_brand") -> DataFrame:
        """Products with their category as both id and name."""
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col(category).alias("category_id"),
            F.col(category).alias("category_name"),
        )

    @property
    def categories(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_brand").alias("category_id"), F.col("p_brand").alias("category_name")
        ).distinct()

    @property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
        )

    @property
    def order_payments(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("payment_value")
        )

    @property
    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_tax").alias("freight_value"),
        )

    @property
    def order_reviews(self) -> DataFrame:
        """Labels are the reviews, the documents' texts their messages."""
        texts = self.raw("documents").select("doc_id", "text")
        return (
            self.raw("labels")
            .join(texts, "doc_id", "left")
            .select(
                F.col("doc_id").alias("order_id"),
                F.col("quality").alias("review_score"),
                F.col("text").alias("review_comment_message"),
            )
        )

    @property
    def deliveries(self) -> DataFrame:
        """Orders delivered with their last shipment and due after 30 days."""
        shipped = (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.max("l_shipdate").alias("order_delivered_customer_date"))
        )
        due = F.col("order_purchase_timestamp") + F.expr("INTERVAL 30 DAYS")
        return self.orders.withColumn("order_estimated_delivery_date", due).join(shipped, "order_id", "left")


def _every(key: str, n: int, faulty: Column, regular: Column) -> Column:
    """``faulty`` in every ``n``-th row by key, ``regular`` in the others."""
    return F.when(F.col(key) % n == 0, faulty).otherwise(regular)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


class Dirty(Roles):
    """Raw text tables made from the same driver tables."""

    @property
    def stg_orders(self) -> DataFrame:
        key, when = "o_orderkey", F.col("o_orderdate")
        late = when + F.expr("INTERVAL 20 DAYS")
        return self.raw("orders").select(
            _every(key, 101, F.lit("  "), F.concat(F.lit(" "), _text(key))).alias("order_id"),
            _every(key, 97, F.lit(""), F.concat(_text("o_custkey"), F.lit(" "))).alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", " Delivered")
            .when(F.col("o_orderstatus") == "O", "SHIPPED ")
            .otherwise("lost")
            .alias("order_status"),
            _every(key, 89, F.date_format(when, "dd-MM-yyyy HH:mm"), _stamp(when)).alias("order_purchase_timestamp"),
            _every(key, 7, F.lit(" "), _stamp(when)).alias("order_approved_at"),
            _every(key, 83, F.lit("2018-02-31 10:00:00"), _stamp(when)).alias("order_delivered_carrier_date"),
            _every(key, 5, F.lit(""), _stamp(late)).alias("order_delivered_customer_date"),
            _stamp(late).alias("order_estimated_delivery_date"),
        )

    @property
    def stg_products(self) -> DataFrame:
        key = "p_partkey"
        size = _text("p_size")
        return self.raw("part").select(
            _every(key, 103, F.lit(" "), F.concat(_text(key), F.lit("  "))).alias("product_id"),
            F.when(F.col(key) % 11 == 0, F.lit(" "))
            .when(F.col(key) % 3 == 0, F.upper("p_type"))
            .when(F.col(key) % 3 == 1, F.concat(F.lit(" "), F.translate("p_type", "AEO", "ÁÉÓ"), F.lit(" ")))
            .otherwise(F.col("p_type"))
            .alias("product_category_name"),
            _every(key, 13, F.lit(""), size).alias("product_name_lenght"),
            _every(key, 17, F.lit("12.5"), size).alias("product_description_lenght"),
            _every(key, 19, F.lit(" "), size).alias("product_photos_qty"),
            _every(key, 107, F.lit("heavy"), F.concat(size, F.lit(".25"))).alias("product_weight_g"),
            _every(key, 23, F.lit(""), size).alias("product_length_cm"),
            size.alias("product_height_cm"),
            F.concat(F.lit(" "), size).alias("product_width_cm"),
        )

    @property
    def stg_sellers(self) -> DataFrame:
        key = "s_suppkey"
        rows = self.raw("supplier").join(
            self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            _every(key, 31, F.lit(""), F.concat(F.lit(" "), _text(key))).alias("seller_id"),
            _every(key, 7, F.lit("  "), F.concat(_text("s_nationkey"), F.lit("00 "))).alias("seller_zip_code_prefix"),
            _every(key, 11, F.lit(" "), F.concat(F.lit(" City "), _text("n_name"))).alias("seller_city"),
            F.substring("n_name", 1, 2).alias("_two"),
        )
        state = F.concat(F.lower("_two"), F.lit(" "))
        once = rows.select("seller_id", "seller_zip_code_prefix", "seller_city", state.alias("seller_state"))
        # Every seller comes twice, the second time in other letters.
        again = once.withColumn("seller_city", F.upper("seller_city"))
        return once.unionByName(again)

    @property
    def stg_order_items(self) -> DataFrame:
        key = "l_orderkey"
        price = F.format_string("%.2f", "l_extendedprice")
        return self.raw("lineitem").select(
            _every(key, 41, F.concat(F.lit("x"), _text(key)), F.concat(_text(key), F.lit(" "))).alias("order_id"),
            F.when(F.col("l_partkey") % 43 == 0, F.concat(_text("l_linenumber"), F.lit(".7")))
            .otherwise(_text("l_linenumber"))
            .alias("order_item_id"),
            _text("l_partkey").alias("product_id"),
            F.concat(F.lit(" "), _text("l_suppkey")).alias("seller_id"),
            _stamp(F.col("l_shipdate")).alias("shipping_limit_date"),
            F.when(F.col("l_partkey") % 47 == 0, F.lit("n/a")).otherwise(price).alias("price"),
            F.format_string("%.2f", "l_tax").alias("freight_value"),
        )

    @property
    def stg_order_payments(self) -> DataFrame:
        key = "o_orderkey"
        return self.raw("orders").select(
            _every(key, 37, F.lit("unknown"), F.concat(F.lit(" "), _text(key))).alias("order_id"),
            F.lit("1").alias("payment_sequential"),
            F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("payment_type"),
            _every(key, 29, F.lit("2.9"), F.lit("3")).alias("payment_installments"),
            _every(key, 53, F.lit(""), F.format_string("%.2f", "o_totalprice")).alias("payment_value"),
        )

    @property
    def stg_order_reviews(self) -> DataFrame:
        key = "doc_id"
        when = F.expr("TIMESTAMP_NTZ '2018-03-05 14:07:00'") + F.expr("make_dt_interval(doc_id % 300)")
        score = F.element_at(
            F.array(*[F.lit(s) for s in ("1", "2", "3", "4", "5", "0", "6", "x", "3.0")]), (F.col(key) % 9 + 1).cast("int")
        )
        return self.raw("documents").select(
            F.concat(F.lit(" r"), _text(key)).alias("review_id"),
            _text(key).alias("order_id"),
            score.alias("review_score"),
            _every(key, 4, F.lit("A"), _every(key, 3, F.lit(" "), F.col("source"))).alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
            _every(key, 59, F.date_format(when, "yyyy-MM-dd HH:mm:ss"), F.date_format(when, "d-M-yyyy HH:mm")).alias(
                "review_creation_date"
            ),
            _every(key, 6, F.lit(""), F.date_format(when, "dd-MM-yyyy HH:mm")).alias("review_answer_timestamp"),
        )

    @property
    def stg_geolocation(self) -> DataFrame:
        key = "event_id"
        lat = F.format_string("%.4f", F.col("value") / 10)
        lng = F.concat(F.lit("4"), F.format_string("%d", F.col("user_id") % 10), F.lit(".5"))
        return self.raw("events").select(
            F.concat(F.lit(" "), _text("user_id")).alias("geolocation_zip_code_prefix"),
            F.when(F.col(key) % 61 == 0, F.lit("1e2"))
            .when(F.col(key) % 67 == 0, F.lit(".5"))
            .when(F.col(key) % 71 == 0, F.lit("91"))
            .when(F.col(key) % 2 == 0, F.concat(F.lit("-"), lat))
            .otherwise(lat)
            .alias("geolocation_lat"),
            _every(key, 73, F.lit("-181"), lng).alias("geolocation_lng"),
            _every(key, 5, F.lit(" "), F.concat(F.lit(" City "), F.upper("event_type"))).alias("geolocation_city"),
            F.substring("event_type", 1, 2).alias("geolocation_state"),
        )
