"""Censored last gaps: masking, predictive mean matching, backfill and before/after checks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import ranking
from cartwheel.plans.skew import global_running_count
from cartwheel.session import shared_dir

# A gap of 30 days means "30 or more".
CENSORED = 30
CHAINS, ITERATIONS, SEED, DONORS = 7, 10, 42, 20


def imputation_users(orders: DataFrame) -> DataFrame:
    """Per user the gap before the last order (NULL where censored) and the number of orders."""
    filled = orders.select(
        "user_id",
        "order_id",
        "order_number",
        F.coalesce("days_since_prior_order", F.lit(0)).alias("days"),
    )
    return ranking.last_order(filled).select(
        "user_id",
        F.nullif(F.col("days"), F.lit(CENSORED)).alias("days_imp"),
        F.col("order_number").alias("frequency"),
    )


def _draw_models(users: DataFrame, chains: int, iters: int, seed: int) -> tuple[int, list[tuple[np.ndarray, np.ndarray]]]:
    """Regression of the gap on user id and frequency, one perturbed set of coefficients per chain.

    The moments of the complete rows come from one aggregate; only a 2 x 2 system is solved here. With a single
    incomplete column each iteration is a fresh draw, so a chain's result is its last one.
    """
    done = users.filter("days_imp IS NOT NULL")
    m = done.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("user_id", "frequency", "days_imp")],
        *[F.var_samp(c).alias(f"var_{c}") for c in ("user_id", "frequency", "days_imp")],
        F.covar_samp("user_id", "frequency").alias("uf"),
        F.covar_samp("user_id", "days_imp").alias("uy"),
        F.covar_samp("frequency", "days_imp").alias("fy"),
    ).first()
    if m["n"] == 0:
        return 0, []
    zero = lambda v: 0.0 if v is None else float(v)
    sxx = np.array([[zero(m["var_user_id"]), zero(m["uf"])], [zero(m["uf"]), zero(m["var_frequency"])]])
    sxy = np.array([zero(m["uy"]), zero(m["fy"])])
    inverse = np.linalg.pinv(sxx)
    slope = inverse @ sxy
    rows = m["n"]
    spread = max(zero(m["var_days_imp"]) - slope @ sxy, 0.0) * max(rows - 1, 0) / max(rows - 3, 1)
    center = np.array([m["avg_days_imp"], m["avg_user_id"], m["avg_frequency"]], dtype=float)
    models = []
    for chain in range(chains):
        rng = np.random.default_rng([seed, chain, iters])
        drawn = rng.multivariate_normal(slope, spread * inverse / max(rows - 1, 1), check_valid="ignore")
        level = center[0] + rng.normal(0.0, np.sqrt(spread / rows))
        models.append((np.array([level, *drawn]), center))
    return rows, models


#: Places to which predictions and their differences count, so that the order of a sum decides nothing.
PLACES = 9


def nearest_donors(predicted: DataFrame, donors: int = DONORS) -> DataFrame:
    """user_id, chain and donors of every row without ``days_imp``: an array of (user_id, days_imp), nearest first.

    ``predicted`` is (user_id, days_imp, chain, predicted), written or checkpointed. Donors are the ``donors`` rows
    with ``days_imp`` of the same chain with the smallest difference of predictions; of equal ones those before the row
    in the order of prediction and user come first, and on either side those that stand nearer to it. Rows without a prediction neither take nor give; a chain with fewer
    complete rows gives what it has, one with none leaves its rows out.

    All chains lie in one order by prediction, in range partitions. In it, the nearest complete rows of a row are among
    the ``donors`` before and the ``donors`` behind its place, wherever partitions begin and end. Places are cut into
    blocks; a row meets the list of the complete rows in its block and ``donors`` beyond either end, 4 x ``donors`` at
    most, and keeps the nearest, so that one row is shuffled for it and not one for each place.
    """
    known = predicted.where("predicted is not null")
    observed = F.col("days_imp").isNotNull()
    ranked = global_running_count(known, ["chain", "predicted", "user_id"], observed, "place")
    block = 2 * donors
    # Places count the complete rows of all chains, so a place names a donor; its chain is compared.
    given = F.struct("place", F.col("chain").alias("of"), F.col("user_id").alias("donor"), F.col("days_imp").alias("given"), F.col("predicted").alias("at"))
    reached = F.sequence(F.floor((F.col("place") - donors) / block), F.floor((F.col("place") + donors - 1) / block))
    pool = ranked.where(observed).select(given.alias("d"), F.explode(reached).alias("block")).groupBy("block").agg(F.collect_list("d").alias("pool"))
    asked = ranked.where(~observed).select("user_id", "chain", "predicted", "place", F.floor(F.col("place") / block).alias("block"))

    def around(d: Column) -> Column:
        return d["place"].between(F.col("place") - (donors - 1), F.col("place") + donors) & (d["of"] == F.col("chain"))

    def near(d: Column) -> Column:
        behind = F.struct(d["at"].alias("at"), d["donor"].alias("donor")) > F.struct("predicted", "user_id")
        return F.struct(
            F.round(F.abs(d["at"] - F.col("predicted")), PLACES).alias("gap"),
            behind.alias("behind"),
            F.when(behind, d["donor"]).otherwise(-d["donor"]).alias("away"),
            d["donor"].alias("user_id"),
            d["given"].alias("days_imp"),
        )

    # The lists are short but many: they are met in a shuffle, never sent to every task.
    met = asked.join(pool.hint("merge"), "block").select(
        "user_id", "chain", F.slice(F.array_sort(F.transform(F.filter("pool", around), near)), 1, donors).alias("near")
    )
    # Rows that share user and chain share their donors.
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, donors)
    chosen = met.groupBy("user_id", "chain").agg(merged.alias("near")).where(F.size("near") > 0)
    pair = F.transform("near", lambda d: F.struct(d["user_id"].alias("user_id"), d["days_imp"].alias("days_imp")))
    return chosen.select("user_id", "chain", pair.alias("donors"))


def impute_pmm(
    users: DataFrame, chains: int = CHAINS, iters: int = ITERATIONS, seed: int = SEED, donors: int = DONORS
) -> DataFrame:
    """Predictive mean matching of ``days_imp`` on user id and frequency.

    A row with a missing gap takes the gap of one of the ``donors`` complete rows whose predictions are nearest to its
    own in the same chain (``nearest_donors``), drawn by hash; the chain results are averaged and rounded half-even.
    """
    shared_dir(users.sparkSession)
    users = users.select("user_id", "days_imp", "frequency").checkpoint()
    rows, models = _draw_models(users, chains, iters, seed)
    if not rows:
        return users.select("user_id", F.col("days_imp").cast("int").alias("days_imp_imputed"))
    coefficients = F.array(
        *[
            F.struct(
                F.lit(chain).alias("chain"),
                (
                    F.lit(float(w[0]))
                    + F.lit(float(w[1])) * (F.col("user_id") - F.lit(float(c[1])))
                    + F.lit(float(w[2])) * (F.col("frequency") - F.lit(float(c[2])))
                ).alias("predicted"),
            )
            for chain, (w, c) in enumerate(models)
        ]
    )
    predicted = users.select("user_id", "days_imp", F.explode(coefficients).alias("m")).select(
        "user_id", "days_imp", "m.chain", F.round("m.predicted", PLACES).alias("predicted")
    )
    pools = nearest_donors(predicted, donors)
    draw = F.pmod(F.xxhash64("user_id", "chain", F.lit(seed)), F.size("donors")) + 1
    drawn = pools.withColumn("donated", F.element_at("donors", draw.cast("int"))["days_imp"])
    estimates = drawn.groupBy("user_id").agg(F.bround(F.avg("donated")).cast("int").alias("estimate"))
    return users.join(estimates, "user_id", "left").select(
        "user_id", F.coalesce(F.col("days_imp").cast("int"), "estimate").alias("days_imp_imputed")
    )


def _masked_orders(orders: DataFrame) -> DataFrame:
    """Order and user of every last order whose gap is censored; one row per user at most."""
    last = ranking.last_order(orders.select("user_id", "order_id", "order_number", "days_since_prior_order"))
    return last.filter(F.col("days_since_prior_order") == CENSORED).select("order_id", "user_id")


def backfill_orders(orders: DataFrame, estimates: DataFrame) -> DataFrame:
    """Replace censored last gaps: by the estimate, else the user's median, else the overall median.

    ``estimates`` has (user_id, days_imp_imputed). Medians leave the masked rows out. Gaps are whole numbers 0..30,
    so the exact-median buffers hold at most 31 values.
    """
    zeroed = orders.withColumn("days_since_prior_order", F.coalesce("days_since_prior_order", F.lit(0)))
    masked = _masked_orders(zeroed)
    marked = zeroed.join(masked.select("order_id", F.lit(True).alias("_masked")), "order_id", "left")
    # At most 31 rows per user, however many orders the user has.
    counts = (
        marked.filter("_masked IS NULL")
        .groupBy("user_id", F.col("days_since_prior_order").alias("days"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    user_median = counts.groupBy("user_id").agg(F.percentile("days", 0.5, F.col("n")).alias("user_median"))
    overall = counts.groupBy("days").agg(F.sum("n").alias("n")).agg(F.percentile("days", 0.5, F.col("n"))).scalar()
    value = F.coalesce(F.col("days_imp_imputed").cast("double"), F.col("user_median"), overall)
    fills = (
        masked.join(estimates.select("user_id", "days_imp_imputed"), "user_id", "left")
        .join(user_median, "user_id", "left")
        .select("order_id", F.bround(value).cast("int").alias("_fill"))
    )
    return (
        zeroed.join(fills, "order_id", "left")
        .withColumn("days_since_prior_order", F.coalesce("_fill", F.col("days_since_prior_order").cast("int")))
        .select(*orders.columns)
    )


def imputation_audit(users: DataFrame, estimates: DataFrame) -> DataFrame:
    return users.join(estimates, "user_id", "left")


def imputation_metrics(orders: DataFrame, users: DataFrame) -> DataFrame:
    rows = orders.agg(F.count(F.lit(1))).scalar()
    return users.agg(
        F.count(F.lit(1)).alias("user_rows"), F.count_if(F.col("days_imp").isNull()).alias("missing_after_mask")
    ).select(rows.alias("input_rows"), "user_rows", "missing_after_mask")


def last_order_share(orders: DataFrame, column: str = "days_since_prior_order") -> DataFrame:
    """Share of last orders among all orders, and of censored gaps among last orders."""
    per_user = orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by(column, F.struct(F.col("order_number"), -F.col("order_id"))).alias("last_days"),
    )
    totals = per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("num_users"),
        F.count_if(F.col("last_days") == CENSORED).alias("last_eq30_count"),
    )
    return totals.select(
        "total_rows",
        "num_users",
        F.coalesce(F.try_divide("num_users", "total_rows"), F.lit(0.0)).alias("share_last_rows"),
        "last_eq30_count",
        F.coalesce(F.try_divide("last_eq30_count", "num_users"), F.lit(0.0)).alias("share_last_eq30"),
    )


def last_order_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Both shares before and after imputation, with their differences."""
    b = last_order_share(before)
    a = last_order_share(after).select(F.struct("*").alias("r")).scalar()
    shares = ("share_last_rows", "share_last_eq30")
    return b.select(
        *[F.col(c).alias(f"{c}_before") for c in shares],
        *[a[c].alias(f"{c}_after") for c in shares],
        *[(a[c] - F.col(c)).alias(f"{c}_delta") for c in shares],
    )


def interval_stats(days: DataFrame, day30: float = 30.0) -> DataFrame:
    """Distribution of valid gaps (see ``quality.valid_intervals``); whole days keep the quantile buffer small."""
    quantiles = F.percentile("days", F.array(*[F.lit(q) for q in (0.10, 0.25, 0.5, 0.75, 0.90)]))
    return days.agg(
        F.count("days").alias("n"),
        F.avg("days").alias("mean"),
        quantiles.alias("q"),
        F.avg((F.col("days") <= day30).cast("double")).alias("share_le_30d"),
    ).select(
        "n",
        "mean",
        F.col("q")[2].alias("median"),
        F.col("q")[0].alias("p10"),
        F.col("q")[1].alias("p25"),
        F.col("q")[3].alias("p75"),
        F.col("q")[4].alias("p90"),
        "share_le_30d",
    )


def interval_delta(before: DataFrame, after: DataFrame, day30: float = 30.0) -> DataFrame:
    b = interval_stats(before, day30)
    a = interval_stats(after, day30).select(F.struct("*").alias("r")).scalar()
    return b.select(
        (a["share_le_30d"] - F.col("share_le_30d")).alias("delta_share_le_30d"),
        (a["mean"] - F.col("mean")).alias("delta_mean_days"),
        (a["median"] - F.col("median")).alias("delta_median_days"),
    )


def interval_histogram(days: DataFrame, bins: int = 60, x_max: float = 60.0) -> DataFrame:
    """Density of the gaps, clipped at ``x_max``, in equal bins between the smallest and largest clipped value."""
    shared_dir(days.sparkSession)
    # Counted by value and kept, so that the frame behind the gaps is computed once for bounds and bins.
    clipped = F.least(F.col("days"), F.lit(float(x_max))).alias("value")
    values = days.filter("days IS NOT NULL").groupBy(clipped).agg(F.count(F.lit(1)).alias("n")).checkpoint()
    lo, hi, total = values.agg(F.min("value"), F.max("value"), F.sum("n")).first()
    if total is None:
        lo, hi, total = 0.0, 1.0, 1
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    index = F.least(F.floor((F.col("value") - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counted = values.select(index.alias("bin"), "n").groupBy("bin").agg(F.sum("n").alias("n"))
    return counted.select(
        "bin", (F.lit(lo) + F.col("bin") * width).alias("left_edge"), "n", (F.col("n") / (total * width)).alias("density")
    )


def histogram_before_after(before: DataFrame, after: DataFrame, bins: int = 60, x_max: float = 60.0) -> DataFrame:
    sides = [interval_histogram(df, bins, x_max).withColumn("side", F.lit(s)) for s, df in (("before", before), ("after", after))]
    return sides[0].unionByName(sides[1])


