"""Every job as a query over the driver's tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null
from ..operators import changes, constraints, referential, rewrites
from ..operators.gated import batch_folder, gated_append, publish, read_published
from ..operators.keys import extend_key_map, keep_last, with_surrogate_key
from ..plans import aggregates, cleaning, dictionary, discount, joins, quality, subqueries, windows
from ..session import shared_dir, tune
from ..sources import sidecars, tables
from ..sources.duplicates import lines_of, without_duplicate_files
from ..sources.encoding import read_repaired_lines
from ..sources.staging import parse_lines, read_staging
from .roles import Dirty

Query = Callable[[SparkSession, str], DataFrame]

REGISTERED: dict[str, Query] = {}

# Parameters of the test tables where the source's own would select nothing.
CANCELLED = ("P",)
GOLD, SILVER = 3_000_000, 2_000_000
ROLLUP_FROM, ROLLUP_TO = "1998-01-01", "1998-02-01"
BOUGHT, NEVER = ("Brand#2",), ("Brand#4", "Brand#5", "Brand#11")
HIGH_VALUE = 400_000


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, decimals as DOUBLE, dates as text: one form in every engine."""
    plain: list[Column] = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegralType, T.BooleanType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        plain.append(column.alias(field.name))
    return df.select(*plain)


def registered(name: str) -> Callable[[Callable], Callable]:
    def keep(job: Callable) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(job(Dirty(tune(spark), str(folder).rstrip("/"))))

        REGISTERED[name] = run
        return job

    return keep


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the place all executors share."""
    return f"{shared_dir(spark)}/tradewind/{name}-{uuid.uuid4().hex}"


# --- scans, sinks, row counts ------------------------------------------------


@registered("scan_table")
def scan_table(d: Dirty) -> DataFrame:
    return d.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")


@registered("scan_csv_staging")
def scan_csv_staging(d: Dirty) -> DataFrame:
    path = scratch(d.spark, "stg_orders")
    tables.write_csv(d.stg_orders, path)
    return read_staging(d.spark, path, "orders")


@registered("scan_csv_multiline")
def scan_csv_multiline(d: Dirty) -> DataFrame:
    path = scratch(d.spark, "stg_order_reviews")
    tables.write_csv(d.stg_order_reviews, path)
    return read_staging(d.spark, path, "order_reviews", multi_line=True).select(
        "review_id", "order_id", "review_comment_message"
    )


@registered("scan_csv_malformed")
def scan_csv_malformed(d: Dirty) -> DataFrame:
    """Lines with a field too many or too few are set aside, the others read."""
    line = F.concat_ws(",", "l_orderkey", "l_linenumber", "l_partkey", F.lit("SP"))
    long = F.when(F.col("l_partkey") % 5 == 0, F.concat(line, F.lit(",more")))
    short = F.when(F.col("l_partkey") % 7 == 0, F.concat_ws(",", "l_orderkey", "l_linenumber"))
    lines = d.raw("lineitem").select(F.coalesce(long, short, line).alias("line"))
    good, bad = parse_lines(lines, "line", "sellers")
    return tables.row_counts({"read": good, "set aside": bad}, "cnt")


@registered("scan_repaired_lines")
def scan_repaired_lines(d: Dirty) -> DataFrame:
    """Lines of text files, repaired while read; the file mixes UTF-8 and Latin-1 lines."""
    path = scratch(d.spark, "mixed")
    lines = d.raw("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    lines.select(_mixed(F.col("line")).cast("string").alias("value")).write.text(path)
    return read_repaired_lines(d.spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def _staging(d: Dirty) -> dict[str, DataFrame]:
    return {
        "orders": d.stg_orders,
        "order_items": d.stg_order_items,
        "products": d.stg_products,
        "sellers": d.stg_sellers,
        "order_payments": d.stg_order_payments,
        "order_reviews": d.stg_order_reviews,
        "geolocation": d.stg_geolocation,
    }


def _from_csv(d: Dirty, name: str) -> DataFrame:
    """A raw table written as a CSV file and read back as text."""
    path = scratch(d.spark, f"csv_{name}")
    tables.write_csv(_staging(d)[name], path)
    return read_staging(d.spark, path, name, multi_line=name == "order_reviews")


@registered("csv_clean_products")
def csv_clean_products(d: Dirty) -> DataFrame:
    raw = _from_csv(d, "products")
    return cleaning.clean_products(raw, cleaning.clean_category_lookup(raw)).accepted


@registered("csv_clean_sellers")
def csv_clean_sellers(d: Dirty) -> DataFrame:
    return cleaning.clean_sellers(_from_csv(d, "sellers")).accepted


@registered("csv_clean_order_items")
def csv_clean_order_items(d: Dirty) -> DataFrame:
    products = cleaning.clean_products(d.stg_products, cleaning.clean_category_lookup(d.stg_products)).accepted
    sellers = cleaning.clean_sellers(d.stg_sellers).accepted
    return cleaning.clean_order_items(_from_csv(d, "order_items"), _known_orders(d), products, sellers).accepted


@registered("csv_clean_order_payments")
def csv_clean_order_payments(d: Dirty) -> DataFrame:
    return cleaning.clean_order_payments(_from_csv(d, "order_payments"), _known_orders(d)).accepted


@registered("csv_clean_order_reviews")
def csv_clean_order_reviews(d: Dirty) -> DataFrame:
    return cleaning.clean_order_reviews(_from_csv(d, "order_reviews"), _known_orders(d)).accepted


@registered("csv_clean_geolocation")
def csv_clean_geolocation(d: Dirty) -> DataFrame:
    return cleaning.clean_geolocation(_from_csv(d, "geolocation")).accepted


@registered("rowcount_staging")
def rowcount_staging(d: Dirty) -> DataFrame:
    """All raw tables written as CSV files and loaded from them."""
    root, loaded = scratch(d.spark, "staging"), {}
    for name, df in _staging(d).items():
        tables.write_csv(df, f"{root}/{name}")
        loaded[f"stg_{name}"] = read_staging(d.spark, f"{root}/{name}", name, multi_line=name == "order_reviews")
    return tables.row_counts(loaded, "cnt")


@registered("rowcount_production")
def rowcount_production(d: Dirty) -> DataFrame:
    folder = scratch(d.spark, "production")
    return tables.row_counts(cleaning.load_production(_staging(d), folder, keep_rejects=False))


@registered("sink_insert_select")
def sink_insert_select(d: Dirty) -> DataFrame:
    """Two appends of query results to one table, read back."""
    folder = scratch(d.spark, "production")
    orders = d.orders
    tables.write_table(orders.filter(F.col("order_status") == "F"), folder, "orders")
    tables.write_table(orders.filter(F.col("order_status") != "F"), folder, "orders")
    return tables.read_table(d.spark, folder, "orders")


@registered("sink_dictionary_csv")
def sink_dictionary_csv(d: Dirty) -> DataFrame:
    """Measured dictionary of the given tables, written as CSV and read back."""
    path = scratch(d.spark, "dictionary")
    tables.write_csv(dictionary.column_profile(_profiled(d)), path)
    names = ["table_name", "position", "column_name", "column_type", "row_count", "null_count", "distinct_count", "key_candidate"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    back = read_staging(d.spark, path, schema)
    counts = {n: F.col(n).cast("bigint") for n in ("position", "row_count", "null_count", "distinct_count")}
    return back.withColumns(counts | {"key_candidate": F.col("key_candidate").cast("boolean")})


@registered("sink_declared_dictionary_csv")
def sink_declared_dictionary_csv(d: Dirty) -> DataFrame:
    """The five-column export, written as CSV and read back, with the rows of each loaded table."""
    path = scratch(d.spark, "declared")
    tables.write_csv(dictionary.dictionary_export(d.spark), path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("table", "column", "type", "nullable", "key")])
    loaded = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("loaded"), "row_count")
        for name, df in _typed(d).items()
    ]
    back = read_staging(d.spark, path, schema).withColumn("key", F.coalesce("key", F.lit("")))
    return back.join(reduce(DataFrame.union, loaded), F.col("table") == F.col("loaded")).drop("loaded")


def _profiled(d: Dirty) -> dict[str, DataFrame]:
    return {n: d.raw(n) for n in ("customer", "lineitem", "orders", "part", "supplier")}


# --- table changes -----------------------------------------------------------


@registered("delete_by_key")
def delete_by_key(d: Dirty) -> DataFrame:
    gone = d.orders.filter(F.col("order_status").isin(*CANCELLED)).select("order_id")
    items = changes.delete_by_key(d.order_items, "order_id", gone)
    left = changes.delete_by_key(d.orders, "order_id", gone)
    return tables.row_counts({"order_items": items, "orders": left}, "cnt")


def _deleted_orders(d: Dirty) -> DataFrame:
    return d.orders.filter(F.col("order_status").isin(*CANCELLED))


@registered("propagate_delete_cascade")
def propagate_delete_cascade(d: Dirty) -> DataFrame:
    items = d.order_items.select("order_id", "order_item_id", "product_id", "price")
    return changes.propagate_delete(items, "order_id", _deleted_orders(d), "order_id", "cascade")


@registered("propagate_delete_restrict")
def propagate_delete_restrict(d: Dirty) -> DataFrame:
    items = d.order_items.select("order_id", "order_item_id", "product_id", "price")
    blockers = changes.propagate_delete(items, "order_id", _deleted_orders(d), "order_id", "restrict")
    return blockers.groupBy("order_id").agg(F.count(F.lit(1)).alias("blocking_rows"))


@registered("propagate_delete_set_null")
def propagate_delete_set_null(d: Dirty) -> DataFrame:
    deleted = d.categories.filter(F.col("category_name").isin(*NEVER))
    return changes.propagate_delete(d.products(), "category_id", deleted, "category_id", "set_null").select(
        "product_id", "category_id"
    )


@registered("delete_over_references")
def delete_over_references(d: Dirty) -> DataFrame:
    """Three deletes over all tables: customers (their orders stand in the way), orders, and categories."""
    sold = {
        "customers": d.customers, "orders": d.orders, "order_items": d.order_items, "order_payments": d.order_payments,
        "order_reviews": d.order_reviews, "products": d.products(), "product_category": d.categories,
    }
    deletes = {
        "customers": d.customers.filter(F.col("customer_state") == 3).select("customer_id"),
        "orders": _deleted_orders(d).select("order_id"),
        "product_category": d.categories.filter(F.col("category_name").isin(*NEVER)).select("category_id"),
    }
    results = []
    for table, keys in deletes.items():
        done = referential.delete_over_references(sold, table, keys)
        ties = done.blockers.select("table", F.concat(F.lit("blocked by "), "column").alias("state"), F.col("blocking_rows").alias("cnt"))
        left = [
            df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table"), F.lit("left").alias("state"), "cnt")
            for name, df in done.tables.items()
        ]
        cleared = done.tables["products"].agg(F.count_if(F.col("category_id").isNull()).alias("cnt"))
        left.append(cleared.select(F.lit("products").alias("table"), F.lit("without category").alias("state"), "cnt"))
        results += [x.select(F.lit(table).alias("deleted"), "table", "state", "cnt") for x in (ties, *left)]
    return reduce(DataFrame.unionByName, results)


@registered("update_from_subquery")
def update_from_subquery(d: Dirty) -> DataFrame:
    nation = d.raw("nation").select("n_nationkey", "n_name", "n_regionkey")
    root = nation.agg(F.max("n_nationkey").alias("v"))
    return changes.update_where_in(nation, "n_regionkey", root.scalar(), "n_name", ["NATION_3", "NATION_4", "NATION_5"])


@registered("rewrite_touched_files")
def rewrite_touched_files(d: Dirty) -> DataFrame:
    """Orders stored in ranges of their ids: a delete and an update, each of which writes one or two of the eight files."""
    root, orders = scratch(d.spark, "published"), d.orders.select("order_id", "order_status", "customer_id")
    tables.clustered(orders, ["order_id"], 8).write.parquet(batch_folder(root, "orders", "load"))
    publish(d.spark, root, "load")
    gone = _deleted_orders(d).filter(F.col("order_id") < 500).select("order_id")
    rewrites.delete_published(d.spark, root, "orders", "delete", "order_id", gone)
    early = F.col("order_id").between(300, 700) & (F.col("order_status") == "O")
    rewrites.update_published(d.spark, root, "orders", "update", early, {"order_status": F.lit("X"), "customer_id": -F.col("customer_id")})
    return read_published(d.spark, root, "orders")


@registered("add_nullable_column")
def add_nullable_column(d: Dirty) -> DataFrame:
    added = changes.add_nullable_column(d.raw("nation"), "parent_category_id", "int")
    return added.agg(
        F.count(F.lit(1)).alias("row_count"), F.count("parent_category_id").alias("filled"), F.max("n_name").alias("last_name")
    )


@registered("insert_values")
def insert_values(d: Dirty) -> DataFrame:
    customer = d.customers.agg(F.min("customer_id").alias("v"))
    orders = changes.insert_values(
        d.orders, [{"order_id": -1, "order_status": "created"}], {"customer_id": customer.scalar()}
    )
    return orders


@registered("fill_default")
def fill_default(d: Dirty) -> DataFrame:
    items = d.order_items.select("order_id", "order_item_id", "price")
    return changes.fill_defaults(items, {"freight_value": F.lit(0).cast("decimal(10,2)"), "price": F.lit(0)})


@registered("surrogate_key")
def surrogate_key(d: Dirty) -> DataFrame:
    """Customers numbered by name, and all events numbered in any order."""
    named = with_surrogate_key(d.customers.select("customer_unique_id"), "id", ["customer_unique_id"])
    numbered = with_surrogate_key(d.raw("events").select("event_id"), "id")
    facts = numbered.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count_distinct("id").alias("n"))
    return named.unionByName(
        facts.select(
            F.col("n").alias("id"), F.concat_ws(":", F.lit("events"), "lo", "hi").alias("customer_unique_id")
        )
    )


@registered("surrogate_key_over_loads")
def surrogate_key_over_loads(d: Dirty) -> DataFrame:
    """Part names numbered over two loads, the second one run twice; the second has all names, the first a third of the parts."""
    root, parts = scratch(d.spark, "keys"), d.raw("part")
    first = parts.filter(F.col("p_partkey") % 3 == 0)
    for batch, rows in (("1", first), ("2", parts), ("2", parts)):
        known = extend_key_map(rows, root, "part_name", batch, "p_name", "name_id")
    return known


@registered("dedup_keep_last")
def dedup_keep_last(d: Dirty) -> DataFrame:
    lines = d.raw("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    return keep_last(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


# --- constraints -------------------------------------------------------------


@registered("validate_not_null")
def validate_not_null(d: Dirty) -> DataFrame:
    raw = d.stg_orders
    blank_free = raw.select(*[blank_to_null(F.col(c)).alias(c) for c in raw.columns])
    return constraints.not_null(blank_free, "orders", raw.columns)


@registered("validate_key")
def validate_key(d: Dirty) -> DataFrame:
    single = constraints.unique(d.orders, "orders", ["order_id"], "primary_key")
    return single.unionByName(constraints.unique(d.order_items, "order_items", ["order_id", "order_item_id"], "primary_key"))


@registered("validate_check")
def validate_check(d: Dirty) -> DataFrame:
    return constraints.check(
        d.order_items,
        "order_items",
        {"chk_price_positive": "price >= 10000", "chk_freight_nonneg": "freight_value >= 0"},
    ).unionByName(constraints.check(d.orders, "orders", {"chk_order_status": "order_status IN ('F', 'O')"}))


@registered("validate_foreign_key")
def validate_foreign_key(d: Dirty) -> DataFrame:
    stray = F.when(F.col("order_item_id") == 7, -F.col("order_id")).otherwise(F.col("order_id"))
    items = d.order_items.withColumn("order_id", stray)
    return constraints.foreign_key(items, "order_items", "order_id", d.orders, "order_id", "orders").unionByName(
        constraints.foreign_key(d.order_items, "order_items", "seller_id", d.sellers, "seller_id", "sellers")
    )


@registered("validate_table")
def validate_table(d: Dirty) -> DataFrame:
    typed = _typed(d)
    return constraints.validate_table(typed["order_items"], "order_items", typed)


def _typed(d: Dirty) -> dict[str, DataFrame]:
    """The typed tables with text keys and known status codes."""
    text = {c: F.col(c).cast("string") for c in ("order_id", "customer_id", "product_id", "seller_id")}

    def with_text(df: DataFrame) -> DataFrame:
        return df.withColumns({c: v for c, v in text.items() if c in df.columns})

    status = F.col("order_status")
    orders = d.orders.withColumns(
        {
            "order_status": F.when(status == "F", "delivered").when(status == "O", "shipped").otherwise("processing"),
            "order_estimated_delivery_date": F.col("order_purchase_timestamp") + F.expr("INTERVAL 30 DAYS"),
        }
    )
    money = {c: F.col(c).cast("decimal(10,2)") for c in ("price", "freight_value")}
    return {
        "customers": with_text(d.customers.select("customer_id", "customer_unique_id")),
        "products": with_text(d.products().select("product_id")),
        "sellers": with_text(d.sellers.select("seller_id")),
        "orders": with_text(orders),
        "order_items": with_text(d.order_items.withColumns(money)),
    }


@registered("q06_gated_append")
def q06_gated_append(d: Dirty) -> DataFrame:
    """A batch with repeated keys and unknown sellers is refused whole, a sound one lands whole."""
    typed = _typed(d)
    parents = {n: typed[n] for n in ("customers", "products", "sellers")}
    root = scratch(d.spark, "gated")
    strays = F.when(F.col("product_id").endswith("7"), F.concat(F.lit("no-"), "seller_id")).otherwise(F.col("seller_id"))
    bad = {"orders": typed["orders"], "order_items": typed["order_items"].withColumn("seller_id", strays)}
    order = ["price", "product_id", "seller_id", "freight_value"]
    good = {
        "orders": typed["orders"],
        "order_items": keep_last(typed["order_items"], ["order_id", "order_item_id"], order),
    }
    reports = [
        gated_append(batch, parents, root, name).withColumn("batch", F.lit(name))
        for name, batch in (("bad", bad), ("good", good))
    ]
    columns = ["batch", "table", "rule", "violations", "accepted"]
    report = reports[0].select(*columns).unionByName(reports[1].select(*columns))
    for name in good:
        stored = read_published(d.spark, root, name).agg(F.count(F.lit(1)).alias("violations"))
        report = report.unionByName(
            stored.select(
                F.lit("stored").alias("batch"),
                F.lit(name).alias("table"),
                F.lit("rows").alias("rule"),
                "violations",
                F.lit(True).alias("accepted"),
            )
        )
    return report


# --- cleaning ----------------------------------------------------------------


def _known_orders(d: Dirty) -> DataFrame:
    return cleaning.clean_orders(d.stg_orders, cleaning.clean_customers(d.stg_orders)).accepted


@registered("clean_customers")
def clean_customers(d: Dirty) -> DataFrame:
    return cleaning.clean_customers(d.stg_orders)


@registered("clean_category_lookup")
def clean_category_lookup(d: Dirty) -> DataFrame:
    return cleaning.clean_category_lookup(d.stg_products)


@registered("clean_products")
def clean_products(d: Dirty) -> DataFrame:
    lookup = cleaning.clean_category_lookup(d.stg_products)
    return cleaning.clean_products(d.stg_products, lookup).accepted


@registered("clean_sellers")
def clean_sellers(d: Dirty) -> DataFrame:
    return cleaning.clean_sellers(d.stg_sellers).accepted


@registered("clean_orders")
def clean_orders(d: Dirty) -> DataFrame:
    return _known_orders(d)


@registered("clean_orders_rejects")
def clean_orders_rejects(d: Dirty) -> DataFrame:
    rejected = cleaning.clean_orders(d.stg_orders, cleaning.clean_customers(d.stg_orders)).rejected
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows_rejected"))


@registered("clean_order_items")
def clean_order_items(d: Dirty) -> DataFrame:
    products = cleaning.clean_products(d.stg_products, cleaning.clean_category_lookup(d.stg_products)).accepted
    sellers = cleaning.clean_sellers(d.stg_sellers).accepted
    return cleaning.clean_order_items(d.stg_order_items, _known_orders(d), products, sellers).accepted


@registered("clean_order_payments")
def clean_order_payments(d: Dirty) -> DataFrame:
    return cleaning.clean_order_payments(d.stg_order_payments, _known_orders(d)).accepted


@registered("clean_order_reviews")
def clean_order_reviews(d: Dirty) -> DataFrame:
    return cleaning.clean_order_reviews(d.stg_order_reviews, _known_orders(d)).accepted


@registered("clean_geolocation")
def clean_geolocation(d: Dirty) -> DataFrame:
    return cleaning.clean_geolocation(d.stg_geolocation).accepted


@registered("clean_rows_accounted_for")
def clean_rows_accounted_for(d: Dirty) -> DataFrame:
    """Per job the accepted and rejected rows together; the category lookup lacks its first name."""
    lookup = cleaning.clean_category_lookup(d.stg_products).filter("category_id > 1")
    orders, products = _known_orders(d), cleaning.clean_products(d.stg_products, lookup)
    jobs = {
        "products": products,
        "orders": cleaning.clean_orders(d.stg_orders, cleaning.clean_customers(d.stg_orders)),
        "order_items": cleaning.clean_order_items(
            d.stg_order_items, orders, products.accepted, cleaning.clean_sellers(d.stg_sellers).accepted
        ),
        "order_payments": cleaning.clean_order_payments(d.stg_order_payments, orders),
        "order_reviews": cleaning.clean_order_reviews(d.stg_order_reviews, orders),
        "geolocation": cleaning.clean_geolocation(d.stg_geolocation),
    }
    counted = [
        job.accepted.select(F.lit(name).alias("table")).union(job.rejected.select(F.lit(name)))
        for name, job in jobs.items()
    ]
    return reduce(DataFrame.union, counted).groupBy("table").agg(F.count(F.lit(1)).alias("rows"))


@registered("clean_products_rejects")
def clean_products_rejects(d: Dirty) -> DataFrame:
    """Why products are set aside when the category lookup lacks its first name."""
    lookup = cleaning.clean_category_lookup(d.stg_products).filter("category_id > 1")
    rejected = cleaning.clean_products(d.stg_products, lookup).rejected
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows_rejected"))


# --- data quality ------------------------------------------------------------


@registered("dq_missing_master")
def dq_missing_master(d: Dirty) -> DataFrame:
    return quality.missing_master(d.stg_orders)


def _mixed(text: Column) -> Column:
    """Bytes that are Latin-1 in every third document and UTF-8 in the others."""
    return F.when(F.col("doc_id") % 3 == 0, F.encode(text, "ISO-8859-1")).otherwise(F.encode(text, "UTF-8"))


def _mixed_bytes(d: Dirty) -> DataFrame:
    return d.raw("documents").select("doc_id", _mixed(F.col("text")).alias("text"))


@registered("dq_repair_encoding")
def dq_repair_encoding(d: Dirty) -> DataFrame:
    return quality.repair_encoding(_mixed_bytes(d), "text")


@registered("dq_repair_encoding_report")
def dq_repair_encoding_report(d: Dirty) -> DataFrame:
    return quality.encoding_report(_mixed_bytes(d), "text")


@registered("dq_sign_inversion")
def dq_sign_inversion(d: Dirty) -> DataFrame:
    samples = d.raw("events").select(
        (F.col("value") / 10).cast("decimal(10,6)").alias("geolocation_lat"),
        (F.lit(40) + F.col("user_id") % 10).cast("decimal(10,6)").alias("geolocation_lng"),
    )
    return quality.sign_inversion(samples)


@registered("dq_date_format")
def dq_date_format(d: Dirty) -> DataFrame:
    return quality.date_formats(d.stg_orders, "order_purchase_timestamp").unionByName(
        quality.date_formats(d.stg_order_reviews, "review_answer_timestamp")
    )


def _file_copies(d: Dirty) -> str:
    """A delivery of text files in three folders; the third repeats the files of the first."""
    path = scratch(d.spark, "copies")
    lines = d.raw("documents").select("lang", F.explode(F.split("text", "\n")).alias("value"))
    english = F.col("lang").eqNullSafe("en")
    for name, rows in (("part_1", english), ("part_2", ~english), ("part_3_copy", english)):
        lines.filter(rows).select("value").write.text(f"{path}/{name}")
    return f"{path}/*"


def _folder(file: str) -> Column:
    return F.regexp_extract(file, r"/(part_\w+)/[^/]*$", 1)


@registered("dq_duplicate_files")
def dq_duplicate_files(d: Dirty) -> DataFrame:
    found = quality.duplicated_files(lines_of(d.spark, _file_copies(d)))
    return found.groupBy(_folder("check").alias("check")).agg(F.sum("rows_affected").alias("rows_affected"))


@registered("dq_duplicate_files_loaded_once")
def dq_duplicate_files_loaded_once(d: Dirty) -> DataFrame:
    kept = without_duplicate_files(lines_of(d.spark, _file_copies(d)))
    return kept.groupBy(_folder("file").alias("folder")).agg(F.count(F.lit(1)).alias("lines"))


@registered("dq_placeholder_text")
def dq_placeholder_text(d: Dirty) -> DataFrame:
    return quality.placeholder_text(d.stg_order_reviews, ["review_comment_title", "review_comment_message"])


@registered("dq_fillers_found")
def dq_fillers_found(d: Dirty) -> DataFrame:
    return quality.found_fillers(d.stg_order_reviews, ["review_comment_title", "review_comment_message"])


@registered("dq_missing_category")
def dq_missing_category(d: Dirty) -> DataFrame:
    return quality.missing_category(d.stg_products)


@registered("dq_missing_dimensions")
def dq_missing_dimensions(d: Dirty) -> DataFrame:
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    lookup = cleaning.clean_category_lookup(d.stg_products)
    return quality.missing_dimensions(cleaning.clean_products(d.stg_products, lookup).accepted, sizes)


@registered("dq_payment_mismatch")
def dq_payment_mismatch(d: Dirty) -> DataFrame:
    return quality.payment_mismatches(d.orders, d.order_payments, d.order_items)


@registered("dq_order_without_payment")
def dq_order_without_payment(d: Dirty) -> DataFrame:
    return quality.orders_without(d.orders, d.order_items, "orders without items")


@registered("dq_delivered_without_date")
def dq_delivered_without_date(d: Dirty) -> DataFrame:
    status = F.when(F.col("order_status") == "F", quality.FINISHED).otherwise(F.col("order_status"))
    return quality.delivered_without_date(d.deliveries.withColumn("order_status", status))


@registered("dq_csv_quoting")
def dq_csv_quoting(d: Dirty) -> DataFrame:
    path = scratch(d.spark, "quoting")
    original = d.raw("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    tables.write_csv(original, path)
    return quality.csv_quoting(read_staging(d.spark, path, original.schema, multi_line=True), original, "text", "doc_id")


# --- the query catalogue -----------------------------------------------------


@registered("q04_dedup_customers")
def q04_dedup_customers(d: Dirty) -> DataFrame:
    return keep_last(d.customers, ["customer_city", "customer_state"], ["customer_id"])


@registered("q05_data_dictionary")
def q05_data_dictionary(d: Dirty) -> DataFrame:
    return dictionary.column_profile(_profiled(d))


@registered("q05_profile_by_sketches")
def q05_profile_by_sketches(d: Dirty) -> DataFrame:
    """Distinct values are given where they are exact: of the columns that may be keys."""
    measured = dictionary.sketch_profile(_profiled(d))
    exact = F.when(~F.col("estimated"), F.col("distinct_count"))
    return measured.select(
        "table_name", "position", "column_name", "column_type", "row_count", "null_count", "key_candidate",
        F.when(F.col("key_candidate"), exact).alias("distinct_count"),
    )


@registered("q05_declared_dictionary")
def q05_declared_dictionary(d: Dirty) -> DataFrame:
    """The declared columns with what the loaded tables hold in them."""
    typed = {n: df for n, df in _typed(d).items()}
    return dictionary.data_dictionary(typed).select(
        "table_name", "position", "column_name", "column_type", "is_nullable", "column_key", "column_default",
        "business_meaning", "row_count", "null_count",
    )


@registered("q07_conflicting_identity")
def q07_conflicting_identity(d: Dirty) -> DataFrame:
    return joins.conflicting_identities(
        d.raw("lineitem"),
        identity=["l_orderkey", "l_linenumber"],
        id_column="l_partkey",
        attributes={"l_suppkey": "supplier", "l_returnflag": "flag"},
    )


@registered("q07_conflict_classes")
def q07_conflict_classes(d: Dirty) -> DataFrame:
    return joins.conflict_classes(
        d.raw("lineitem"),
        identity=["l_orderkey", "l_linenumber"],
        id_column="l_partkey",
        attributes={"l_suppkey": "supplier", "l_returnflag": "flag"},
    )


@registered("q08_orphans_staging")
def q08_orphans_staging(d: Dirty) -> DataFrame:
    items = d.stg_order_items.select(F.trim("order_id").alias("order_id"), F.trim("product_id").alias("product_id"))
    orders = d.stg_orders.select(F.trim("order_id").alias("order_id"))
    products = d.stg_products.select(F.trim("product_id").alias("product_id"))
    return joins.orphans(
        items,
        {"orphan_order": ("order_id", orders, "order_id"), "orphan_product": ("product_id", products, "product_id")},
    )


@registered("q08_orphans_production")
def q08_orphans_production(d: Dirty) -> DataFrame:
    return joins.orphans(
        d.order_items,
        {
            "orphan_order_prod": ("order_id", d.orders, "order_id"),
            "orphan_product_prod": ("product_id", d.products(), "product_id"),
            "orphan_seller_prod": ("seller_id", d.sellers, "seller_id"),
        },
    )


@registered("q09_never_ordered")
def q09_never_ordered(d: Dirty) -> DataFrame:
    """Every customer of the driver's tables has an order, so users with events stand in for buyers."""
    buyers = d.raw("events").select(F.col("user_id").alias("customer_id"))
    return joins.never_ordered(d.customers, buyers)


@registered("q10_payment_mismatch")
def q10_payment_mismatch(d: Dirty) -> DataFrame:
    return joins.payment_mismatch(d.orders, d.order_payments, d.order_items)


@registered("q10_payment_mismatch_fine")
def q10_payment_mismatch_fine(d: Dirty) -> DataFrame:
    """All mismatches above a tolerance between two cents."""
    found = joins.payment_mismatch(d.orders, d.order_payments, d.order_items, tolerance=0.015, n=None)
    return found.select("order_id", "discrepancy")


@registered("q11_mom_growth")
def q11_mom_growth(d: Dirty) -> DataFrame:
    return aggregates.monthly_growth(d.orders, d.order_items, CANCELLED)


@registered("q12_top_products_per_category")
def q12_top_products_per_category(d: Dirty) -> DataFrame:
    return aggregates.top_products_per_category(d.order_items, d.products())


@registered("q13_clv_tiers")
def q13_clv_tiers(d: Dirty) -> DataFrame:
    return aggregates.lifetime_value_tiers(d.customers, d.orders, d.order_payments, GOLD, SILVER)


@registered("q14_sales_rollup")
def q14_sales_rollup(d: Dirty) -> DataFrame:
    return aggregates.sales_rollup(d.orders, d.order_items, ROLLUP_FROM, ROLLUP_TO)


@registered("q15_top_category_per_month")
def q15_top_category_per_month(d: Dirty) -> DataFrame:
    return aggregates.top_category_per_month(d.orders, d.order_items, d.products())


@registered("q16_customer_360")
def q16_customer_360(d: Dirty) -> DataFrame:
    return joins.customer_360(d.customers, d.orders, d.order_items, d.products(), d.categories, d.order_reviews)


@registered("q17_bought_a_never_b")
def q17_bought_a_never_b(d: Dirty) -> DataFrame:
    return joins.bought_but_never(d.customers, d.orders, d.order_items, d.products(), BOUGHT, NEVER)


@registered("q18_best_product_per_seller_category")
def q18_best_product_per_seller_category(d: Dirty) -> DataFrame:
    return joins.best_product_per_seller(d.sellers, d.order_items, d.products("p_type"))


@registered("q19_market_basket")
def q19_market_basket(d: Dirty) -> DataFrame:
    return joins.market_basket(d.order_items)


@registered("q20_shipping_delays")
def q20_shipping_delays(d: Dirty) -> DataFrame:
    return joins.shipping_delays(d.deliveries, d.customers, d.order_items, d.sellers)


@registered("q21_above_state_average")
def q21_above_state_average(d: Dirty) -> DataFrame:
    return subqueries.above_state_average(d.customers, d.orders, d.order_payments)


@registered("q21_correlated")
def q21_correlated(d: Dirty) -> DataFrame:
    return subqueries.above_state_average_correlated(d.customers, d.orders, d.order_payments)


@registered("q22_second_product")
def q22_second_product(d: Dirty) -> DataFrame:
    return subqueries.nth_product_per_category(d.order_items, d.products())


@registered("q22_count_greater")
def q22_count_greater(d: Dirty) -> DataFrame:
    return subqueries.nth_product_per_category(d.order_items, d.products(), dense=False)


@registered("q23_category_tree")
def q23_category_tree(d: Dirty) -> DataFrame:
    key = F.col("n_nationkey")
    nodes = d.raw("nation").select(
        key.alias("category_id"),
        F.col("n_name").alias("category_name"),
        F.when(key > 0, F.floor((key - 1) / 2).cast("int")).alias("parent_category_id"),
    )
    return subqueries.category_tree(nodes)


@registered("q23_grouped_categories")
def q23_grouped_categories(d: Dirty) -> DataFrame:
    """The catalogue's own categories with three of them put under a group."""
    lookup = cleaning.clean_category_lookup(d.products("p_brand").withColumnRenamed("category_name", "product_category_name"))
    members = [b.lower() for b in NEVER]
    return subqueries.category_tree(subqueries.grouped_categories(lookup, members=members))


@registered("q24_consecutive_months")
def q24_consecutive_months(d: Dirty) -> DataFrame:
    return subqueries.consecutive_months(d.customers, d.orders)


@registered("q25_moving_average")
def q25_moving_average(d: Dirty) -> DataFrame:
    return windows.moving_average(d.orders)


@registered("q25_moving_average_events")
def q25_moving_average_events(d: Dirty) -> DataFrame:
    return windows.moving_average(d.raw("events").select(F.col("ts").alias("order_purchase_timestamp")))


@registered("q26_order_gap")
def q26_order_gap(d: Dirty) -> DataFrame:
    return windows.order_gaps(d.orders)


@registered("q26_order_gap_hot_customer")
def q26_order_gap_hot_customer(d: Dirty) -> DataFrame:
    """A third of all orders is one customer's."""
    hot = F.when(F.col("order_id") % 3 == 0, 1).otherwise(F.col("customer_id"))
    return windows.order_gaps(d.orders.withColumn("customer_id", hot))


@registered("q27_top_sellers_per_state")
def q27_top_sellers_per_state(d: Dirty) -> DataFrame:
    return windows.top_sellers_per_state(d.sellers, d.order_items)


@registered("q28_running_total")
def q28_running_total(d: Dirty) -> DataFrame:
    return windows.running_revenue(d.orders, d.order_items)


def _requests(d: Dirty) -> DataFrame:
    return d.raw("orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("order_value"),
        F.col("o_orderkey").alias("as_of_order_id"),
    )


@registered("q29_discount")
def q29_discount(d: Dirty) -> DataFrame:
    return discount.discounts(_requests(d), d.orders, high_value_above=HIGH_VALUE)


@registered("q29_discount_unknown_orders")
def q29_discount_unknown_orders(d: Dirty) -> DataFrame:
    """One request per customer for an order that does not exist yet: all orders count."""
    asked = d.raw("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.abs("c_acctbal").cast("decimal(10,2)").alias("order_value"),
        (-F.col("c_custkey") - 1).alias("as_of_order_id"),
    )
    return discount.discounts(asked, d.orders)


def _laid_out(d: Dirty, name: str, source: DataFrame, raw: str, write) -> DataFrame:
    """A table in one of the layouts, written once per session and state of the source's files."""
    files = d.raw(raw).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    state = files.agg(F.bit_xor(F.xxhash64(*files.columns))).first()[0]
    table = f"{name}_{hashlib.sha256(f'{d.folder} {state}'.encode()).hexdigest()[:12]}"
    if not d.spark.catalog.tableExists(table):
        write(source, table, scratch(d.spark, table), tables.LAYOUTS[name])
    return d.spark.table(table)


@registered("q30_layout")
def q30_layout(d: Dirty) -> DataFrame:
    return joins.market_basket(_laid_out(d, "items_order_product", d.order_items, "lineitem", tables.write_bucketed))


@registered("q30_layout_bought_a_never_b")
def q30_layout_bought_a_never_b(d: Dirty) -> DataFrame:
    items = _laid_out(d, "items_order_product", d.order_items, "lineitem", tables.write_bucketed)
    return joins.bought_but_never(d.customers, d.orders, items, d.products(), BOUGHT, NEVER)


@registered("q30_layout_top_products")
def q30_layout_top_products(d: Dirty) -> DataFrame:
    items = _laid_out(d, "items_product_price", d.order_items, "lineitem", tables.write_bucketed)
    return aggregates.top_products_per_category(items, d.products())


@registered("q30_layout_order_gap")
def q30_layout_order_gap(d: Dirty) -> DataFrame:
    return windows.order_gaps(_laid_out(d, "orders_customer_purchase", d.orders, "orders", tables.write_clustered))


@registered("q30_lookup_by_second_column")
def q30_lookup_by_second_column(d: Dirty) -> DataFrame:
    """The items of a few products from a table laid out by order: only files that may hold them are read."""
    path, side = scratch(d.spark, "items"), scratch(d.spark, "items_files")
    items = d.order_items.select("order_id", "order_item_id", "product_id", "price")
    tables.clustered(items, tables.LAYOUTS["items_order_product"], 16).write.parquet(path)
    sidecars.write_sidecar(d.spark, path, side, tables.LAYOUTS["items_order_product"][1:])
    wanted = d.products().filter(F.col("product_id") <= 3).select("product_id")
    return sidecars.read_matching(d.spark, path, side, "product_id", wanted)
