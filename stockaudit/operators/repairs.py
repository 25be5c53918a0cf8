"""Set-based repairs of the status history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockaudit.operators import checks as c
from stockaudit.session import cut_lineage
from stockaudit.sources.loading import assign_surrogate_keys
from stockaudit.tables import replace

COLUMNS = ["history_id", "order_id", "status", "changed_at"]
#: Rows of a history that are handled as one array.
LONGEST = 1000


def repair_latest_status(orders: DataFrame, history: DataFrame, last_id: int = 0) -> DataFrame:
    """Make the newest history row of each order show the order's status.

    Where the newest status differs from the order's status s: if the history has s, its newest row is
    moved to one second after the newest other row and its other rows are deleted; if not, such a row is inserted, with an id
    above those of the history and ``last_id``.
    """
    current = orders.select("order_id", F.col("status").alias("wanted"))
    fits = F.col("status").eqNullSafe(F.col("wanted"))
    # The newest row per order and status is all the join needs: a few rows per order, however long its history.
    newest = F.max(F.struct("changed_at", "history_id")).alias("_newest")
    facts = (
        history.groupBy("order_id", "status").agg(newest)
        .join(current, "order_id")
        .groupBy("order_id", "wanted")
        .agg(
            F.max_by("status", "_newest").alias("_last"),
            F.max(F.when(fits, F.col("_newest.history_id"))).alias("_kept"),
            F.max(F.when(~fits, F.col("_newest.changed_at"))).alias("_after"),
        )
        .filter(F.col("_last") != F.col("wanted"))
    )
    moved_to = F.col("_after") + F.make_dt_interval(secs=F.lit(1))
    repaired = (
        history.join(facts, "order_id", "left")
        .filter(F.col("wanted").isNull() | ~fits | (F.col("history_id") == F.col("_kept")))
        .withColumn("changed_at", F.when(F.col("history_id") == F.col("_kept"), moved_to).otherwise(F.col("changed_at")))
        .select(*COLUMNS)
    )
    missing = facts.filter(F.col("_kept").isNull()).select(
        "order_id", F.col("wanted").alias("status"), moved_to.alias("changed_at"))
    highest = F.greatest(history.agg(F.max("history_id")).scalar(), F.lit(last_id))
    return repaired.unionByName(assign_surrogate_keys(missing, ["order_id"], "history_id", highest))


def repair_invalid_transitions(history: DataFrame) -> DataFrame:
    """Delete every row that an illegal move leads to, all in one pass."""
    return c.with_previous_status(history).filter(~c.illegal_move()).select(*COLUMNS)


def repair_repeated_status(history: DataFrame) -> DataFrame:
    repeated = F.coalesce(F.col("prev_status") == F.col("status"), F.lit(False))
    return c.with_previous_status(history).filter(~repeated).select(*COLUMNS)


def repair_history_pipeline(t, max_passes: int | None = 1, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """The three repairs in sequence; returns the step report and the repaired history.

    Each check is counted on the history the repairs before it left. One pass need not converge; further passes stop
    as soon as one finds nothing. ``max_passes=None`` goes on until a pass changes nothing; what it still finds are
    orders whose last status no legal move reaches, so that one repair adds the row which another deletes.

    Orders don't depend on each other, so one job takes each through all its passes. Histories of more than ``longest`` rows
    go through the three repairs as tables instead, pass by pass. Rows that the first pass adds are numbered by order above the
    highest id, then those of later passes, then those of long histories. Order ids of ``orders`` are unique (U1).
    """
    spark, history = t.orders.sparkSession, t.order_history.select(*COLUMNS)
    sizes = history.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > longest)
    long_ones = cut_lineage(sizes.select(F.col("order_id").alias("_long")))
    split = not long_ones.isEmpty()
    is_long = history["order_id"].eqNullSafe(long_ones["_long"])
    last_id = history.agg(F.coalesce(F.max("history_id"), F.lit(0))).first()[0]

    settled = _settled(t.orders, history.join(long_ones, is_long, "left_anti") if split else history, last_id, max_passes)
    counted = settled.select("order_id", F.posexplode("done").alias("step", "_c")).groupBy("step").agg(
        F.sum("_c.found").alias("found"), F.sum("_c.changed").alias("changed"))
    steps: dict[int, tuple[int, int]] = {r.step: (r.found, r.changed) for r in counted.collect()}
    # Orders that stand still with violations show the counts of their last pass in every later one.
    ends = [F.struct(*[F.sum(F.get("done", F.size("done") - 3 + k)[n]).alias(n) for n in ("found", "changed")]).alias(f"_{k}")
            for k in range(3)]
    stuck = settled.filter(F.get("done", F.size("done") - 3)["found"] > 0).groupBy(F.size("done").alias("_upto")).agg(*ends)
    standing = [(r._upto, [tuple(r[f"_{k}"]) for k in range(3)]) for r in stuck.collect()]

    rows = settled.select("order_id", F.inline("rows")).select(*COLUMNS)
    last_id = max(last_id, rows.agg(F.max("history_id")).first()[0] or 0)
    if max_passes != 1:
        added = rows.filter(F.col("history_id").isNull()).drop("history_id")
        rows = rows.filter(F.col("history_id").isNotNull()).unionByName(
            assign_surrogate_keys(added, ["order_id"], "history_id", last_id))
    if split:
        if max_passes != 1:
            last_id += added.count()
        in_passes, repaired, stands = _in_passes(t, history.join(long_ones, is_long, "left_semi"), last_id, max_passes)
        rows = rows.unionByName(repaired)
        for i, (found, changed) in enumerate(in_passes):
            steps[i] = tuple(map(sum, zip(steps.get(i, (0, 0)), (found, changed))))
        if stands:
            standing.append((len(in_passes), in_passes[-3:]))

    report: list[tuple[int, str, int, int]] = []
    passes = max_passes or max(1, -(-len(steps) // 3))
    for p in range(passes):
        found_in_pass = 0
        for k, check_id in enumerate(("D1", "D2", "D3")):
            later = [counts[k] for upto, counts in standing if upto <= 3 * p]
            found, changed = map(sum, zip(steps.get(3 * p + k, (0, 0)), *later))
            report.append((len(report) + 1, check_id, found, changed))
            found_in_pass += found
        if not found_in_pass:
            break
    return spark.createDataFrame(report, "step INT, check_id STRING, violations_before BIGINT, rows_changed BIGINT"), rows


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _settled(orders: DataFrame, history: DataFrame, last_id: int, max_passes: int | None) -> DataFrame:
    """Each order's rows after its passes and the (found, changed) of every step it took, from one job.

    An order takes passes until one leaves it as it was. Two passes in a row that don't end it delete a row at least, so that
    twice its rows and four more are always enough.
    """
    entry = F.struct("changed_at", "history_id", "status")
    wanted = orders.groupBy("order_id").agg(F.max("status").alias("wanted"))
    groups = history.groupBy("order_id").agg(F.sort_array(F.collect_list(entry)).alias("rows")).join(wanted, "order_id", "left")
    groups = cut_lineage(groups)
    lacks = (F.get("rows", F.size("rows") - 1)["status"] != F.col("wanted")) & ~F.exists(
        "rows", lambda x: x["status"].eqNullSafe(F.col("wanted")))
    ids = assign_surrogate_keys(groups.filter(lacks).select("order_id"), ["order_id"], "_new_id", last_id)
    groups = groups.join(ids, "order_id", "left")

    def state(s: Column, rows: Column, found: Column, changed: Column, ends_pass: bool = False) -> Column:
        count = F.struct(found.cast("bigint").alias("found"), changed.cast("bigint").alias("changed"))
        return F.struct(
            rows.alias("rows"), (rows if ends_pass else s["begun"]).alias("begun"),
            F.concat(s["done"], F.array(count)).alias("done"),
            (rows.eqNullSafe(s["begun"]) if ends_pass else F.lit(False)).alias("still"))

    def show_latest(s: Column) -> Column:
        others = F.filter(s["rows"], lambda x: ~x["status"].eqNullSafe(F.col("wanted")))
        own = F.filter(s["rows"], lambda x: x["status"].eqNullSafe(F.col("wanted")))

        def moved(own: Column) -> Column:
            row = F.struct(
                (F.get(others, F.size(others) - 1)["changed_at"] + F.make_dt_interval(secs=F.lit(1))).alias("changed_at"),
                F.when(F.size(own) > 0, F.get(own, F.size(own) - 1)["history_id"]).otherwise(F.col("_new_id")).alias("history_id"),
                F.col("wanted").alias("status"))
            return state(s, F.sort_array(F.concat(others, F.array(row))), F.lit(1), F.greatest(F.size(own), F.lit(1)))

        return F.when(
            F.get(s["rows"], F.size(s["rows"]) - 1)["status"] != F.col("wanted"), _let(own, moved),
        ).otherwise(state(s, s["rows"], F.lit(0), F.lit(0)))

    def delete(s: Column, bad, ends_pass: bool) -> Column:
        def without(kept: Column) -> Column:
            gone = F.size(s["rows"]) - F.size(kept)
            return state(s, kept, gone, gone, ends_pass)

        return _let(F.filter(s["rows"], lambda x, i: ~F.coalesce(
            bad(F.get(s["rows"], i - 1)["status"], x["status"]), F.lit(False))), without)

    def step(s: Column, i: Column) -> Column:
        return (
            F.when(s["still"], s)
            .when(i % 3 == 0, show_latest(s))
            .when(i % 3 == 1, delete(s, c.illegal_move, False))
            .otherwise(delete(s, lambda prev, status: prev == status, True))
        )

    enough = F.size("rows") * 2 + 4
    steps = F.sequence(F.lit(0), (F.least(enough, F.lit(max_passes)) if max_passes else enough) * 3 - 1)
    nothing = F.array().cast("array<struct<found: bigint, changed: bigint>>")
    begin = F.struct(F.col("rows").alias("rows"), F.col("rows").alias("begun"), nothing.alias("done"), F.lit(False).alias("still"))
    return cut_lineage(
        groups.select("order_id", F.aggregate(steps, begin, step).alias("_end")).select("order_id", "_end.rows", "_end.done"))


def _in_passes(t, history: DataFrame, last_id: int, max_passes: int | None) -> tuple[list[tuple[int, int]], DataFrame, bool]:
    """The passes over whole tables: (found, changed) of each step, the repaired rows, whether violations stay for good."""
    steps = (
        (c.d1_latest_status_mismatch, lambda h: repair_latest_status(t.orders, h, last_id)),
        (c.d2_invalid_transitions, repair_invalid_transitions),
        (c.d3_repeated_status, repair_repeated_status),
    )
    report: list[tuple[int, int]] = []
    while max_passes is None or len(report) < 3 * max_passes:
        begun = history
        for check, repair in steps:
            found = check(replace(t, order_history=history)).count()
            changed = 0
            if found:
                repaired = cut_lineage(repair(history))
                changed = _rows_changed(history, repaired)
                history = repaired
            report.append((found, changed))
        if not any(found for found, _ in report[-3:]):
            return report, history, False
        if not _rows_changed(begun, history):
            return report, history, True
    return report, history, False


def _rows_changed(before: DataFrame, after: DataFrame) -> int:
    """Rows deleted, inserted or moved."""
    old = before.select("history_id", F.col("changed_at").alias("_old"), F.lit(True).alias("_b"))
    new = after.select("history_id", F.col("changed_at").alias("_new"), F.lit(True).alias("_a"))
    differs = F.col("_a").isNull() | F.col("_b").isNull() | ~F.col("_old").eqNullSafe(F.col("_new"))
    return old.join(new, "history_id", "full_outer").filter(differs).count()
