"""Loading the tables: counts, defaults, computed columns, ids, idempotent inserts and upserts."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockaudit.functions import columns as c
from stockaudit.functions.parameters import DEFAULT_PRICE_BAND, PRICE_BANDS, PURCHASE_PRICE_SHARE
from stockaudit.operators.existence import without_match
from stockaudit.schemas import DEFAULTS, NOW, TABLE_NAMES, schema_of
from stockaudit.session import cut_lineage

PAIR = ["store_id", "product_id"]


def table_row_counts(t) -> DataFrame:
    counts = [
        getattr(t, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in TABLE_NAMES
    ]
    return reduce(DataFrame.unionByName, counts)


def apply_column_defaults(df: DataFrame, table: str, now: datetime.datetime) -> DataFrame:
    """Fill absent columns and NULLs with the declared defaults of ``table``."""
    types = {f.name: f.dataType for f in schema_of(table).fields}

    def filled(name, value):
        default = F.lit(now if value == NOW else value).cast(types[name])
        return F.coalesce(F.col(name), default) if name in df.columns else default

    return df.withColumns({name: filled(name, value) for name, value in DEFAULTS.get(table, {}).items()})


def order_line_totals(items: DataFrame) -> DataFrame:
    return items.select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(21,2)").alias("line_total"),
    )


def assign_surrogate_keys(
    rows: DataFrame, natural_key: Sequence[str], id_column: str, max_id: Column | int = 0, partitions: int | None = None
) -> DataFrame:
    """Dense ids above ``max_id`` in natural-key order, without a single-task window.

    Rows are range partitioned by the key and stored, so the partition of a row is fixed; ids are then
    the rows of the earlier partitions plus the row number inside the partition.
    """
    ranged = (rows.repartitionByRange(partitions, *natural_key) if partitions
              else rows.repartitionByRange(*natural_key))
    stored = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))
    # One row per partition, so this ordering is over a handful of counts.
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy(*natural_key)
    return (
        stored.withColumn("_rn", F.row_number().over(within))
        .join(F.broadcast(offsets), "_part")
        .withColumn(id_column, (max_id + F.col("_before") + F.col("_rn")).cast("bigint"))
        .select(id_column, *rows.columns)
    )


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, as an aggregate that combines before the shuffle."""
    rest = [n for n in rows.columns if n not in key]
    if not rest:
        return rows.distinct()
    return (
        rows.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*key, *[F.col("_row")[n].alias(n) for n in rest])
        .select(*rows.columns)
    )


def insert_if_absent(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The target plus the source rows (first per key) whose key it lacks; ``origin`` tells which."""
    new = without_match(first_per_key(source, key, order or key), target, key)
    return target.withColumn("origin", F.lit("existing")).unionByName(
        new.withColumn("origin", F.lit("inserted")), allowMissingColumns=True)


def upsert_products(products: DataFrame, source: DataFrame, categories: DataFrame, max_id: int) -> DataFrame:
    """Upsert by SKU. ``source``: seq, sku, name, shelf_life_days, category; the last row of a SKU counts.

    An unknown SKU is inserted (rows of unknown categories are skipped), a known one takes name and
    shelf life only when the name differs.
    """
    known = categories.select(F.col("name").alias("category"), "category_id")
    last = (
        source.join(known, "category")
        .groupBy("sku")
        .agg(F.max_by(F.struct("name", "shelf_life_days", "category_id"), "seq").alias("s"))
    )
    kept = products.select("product_id", "category_id", "name", "sku", "shelf_life_days").join(last, "sku", "left")
    renamed = F.col("s").isNotNull() & (F.col("s.name") != F.col("name"))
    existing = kept.select(
        "product_id", "category_id", F.when(renamed, F.col("s.name")).otherwise(F.col("name")).alias("name"), "sku",
        F.when(renamed, F.col("s.shelf_life_days")).otherwise(F.col("shelf_life_days")).alias("shelf_life_days"),
        F.when(renamed, "updated").otherwise("unchanged").alias("action"),
    )
    new = without_match(last, products, ["sku"]).select(
        "s.category_id", "s.name", "sku", "s.shelf_life_days", F.lit("inserted").alias("action"))
    return existing.unionByName(assign_surrogate_keys(new, ["sku"], "product_id", max_id))


def dedupe_customers(
    existing: DataFrame, batch: DataFrame, target_rows: int | None = None, order: str = "customer_id"
) -> DataFrame:
    """New customers whose phone is neither known nor earlier in the batch; with ``target_rows`` none once the table is full."""
    if target_rows is not None:
        batch = batch.filter(existing.agg(F.count(F.lit(1))).scalar() < F.lit(target_rows))
    new = without_match(first_per_key(batch, ["phone_number"], [order]), existing, ["phone_number"])
    return existing.withColumn("origin", F.lit("existing")).unionByName(
        new.withColumn("origin", F.lit("inserted")), allowMissingColumns=True)


def build_assortment(stores: DataFrame, products: DataFrame, inventory: DataFrame, on_hand: int) -> DataFrame:
    """Inventory rows for the (store, product) pairs that have none yet.

    Each product carries the stores it lacks as an array, so only absent pairs are ever produced; the
    arrays are as long as the store list.
    """
    every_store = stores.agg(F.collect_set("store_id")).scalar()
    stocked = inventory.groupBy("product_id").agg(F.collect_set("store_id").alias("stocked"))
    lacking = F.when(F.col("stocked").isNull(), F.col("every")).otherwise(F.array_except("every", "stocked"))
    return (
        products.select("product_id").join(stocked, "product_id", "left")
        .withColumn("every", every_store)
        .select(F.explode(lacking).alias("store_id"), "product_id", F.lit(on_hand).alias("quantity_on_hand"),
                F.lit(20).alias("reorder_point"), F.lit(100).alias("reorder_quantity"))
    )


def price_bands(spark, bands: dict[str, tuple[float, float]] = PRICE_BANDS) -> DataFrame:
    """Category bands as a relation: category, lo, hi."""
    rows = ", ".join(f"('{name}', {lo}, {hi})" for name, (lo, hi) in bands.items())
    return spark.sql(
        f"SELECT category, CAST(lo AS DECIMAL(10,2)) AS lo, CAST(hi AS DECIMAL(10,2)) AS hi "
        f"FROM VALUES {rows} AS b(category, lo, hi)")


def with_price_band(rows: DataFrame, products: DataFrame, categories: DataFrame, bands: DataFrame) -> DataFrame:
    """Attach lo and hi of the product's category; unknown products and categories take the default band."""
    lo, hi = (F.lit(v).cast("decimal(10,2)") for v in DEFAULT_PRICE_BAND)
    by_product = (
        products.select("product_id", "category_id")
        .join(categories.select("category_id", F.col("name").alias("category")), "category_id")
        .join(bands, "category")
        .select("product_id", "lo", "hi")
    )
    return rows.join(by_product, "product_id", "left").withColumns(
        {"lo": F.coalesce("lo", lo), "hi": F.coalesce("hi", hi)})


def purchase_price(lo: str = "lo", hi: str = "hi"):
    """The middle of the band times the purchase share."""
    share = F.lit(PURCHASE_PRICE_SHARE).cast("decimal(3,2)") / 2
    return F.round(((F.col(lo) + F.col(hi)) * share).cast("decimal(18,6)"), 2).cast("decimal(10,2)")


def initial_purchase_order_lines(t, bands: DataFrame, purchase_orders: DataFrame) -> DataFrame:
    """Lines of the opening order of each store that has no purchase order: all its stock, received."""
    fresh = without_match(t.dark_store.select("store_id"), purchase_orders, ["store_id"])
    first_supplier = t.supplier.agg(F.min("supplier_id")).scalar()
    stock = t.store_inventory.select(*PAIR, "quantity_on_hand").join(fresh, "store_id", "left_semi")
    return with_price_band(stock, t.product, t.category, bands).select(
        "store_id", first_supplier.alias("supplier_id"), "product_id",
        F.col("quantity_on_hand").alias("quantity_ordered"), F.col("quantity_on_hand").alias("quantity_received"),
        purchase_price().alias("unit_price"),
    )


def initial_purchase_orders(lines: DataFrame, ordered_at: datetime.datetime) -> DataFrame:
    """One received header per store of ``lines``."""
    total = F.round(F.sum(F.col("quantity_ordered") * F.col("unit_price")), 2)
    return lines.groupBy("store_id", "supplier_id").agg(total.cast("decimal(14,2)").alias("total_price")).select(
        "store_id", "supplier_id", F.lit("received").alias("status"), "total_price",
        F.lit(ordered_at).cast("timestamp_ntz").alias("ordered_at"),
        F.lit(ordered_at).cast("timestamp_ntz").alias("received_at"),
    )


def initial_restocks(lines: DataFrame, ordered_at: datetime.datetime) -> DataFrame:
    """The opening ledger rows of ``lines``."""
    return lines.select(
        *PAIR, F.lit("restock").alias("transaction_type"), F.col("quantity_received").alias("quantity_delta"),
        F.col("quantity_received").alias("quantity_after"),
        F.lit(ordered_at).cast("timestamp_ntz").alias("timestamp_occurred"),
    )


def supplier_contact_email(suppliers: DataFrame) -> DataFrame:
    return suppliers.select("supplier_id", "name", c.contact_email(F.col("name")).alias("email"))


def mask_secret_column(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, c.mask_secret(F.col(text)).alias("masked"))
