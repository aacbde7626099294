"""Join operators. Dimension sides are broadcast only when their size is fixed or has been counted."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratemill import fixed, session
from ratemill.functions import recode as R
from ratemill.session import broadcast_if_small

OPEN = 1 << 20      # stands for the power of two of a band without one of its ends


def left_join_spreading_nulls(left: DataFrame, right: DataFrame, key: str, spread: str, also: Sequence[str] = (), rows: int = 0) -> DataFrame:
    """Left join on a key that many left rows lack. Rows without it match nothing, yet a plain join would send
    them all to one task; here they are hashed by ``spread`` instead. ``rows``, the left rows where they have been
    counted, sets the number of tasks."""
    kind = left.schema[key].dataType
    l = left.withColumns({"_absent": F.col(key).isNull(), "_k": F.coalesce(F.col(key), F.col(spread).cast(kind))})
    r = right.withColumnRenamed(key, "_k").withColumn("_absent", F.lit(False))
    return session.spread(l, rows, "_k", *also).join(r, ["_absent", "_k", *also], "left").drop("_absent", "_k")


def party_contracts(parties: DataFrame, contracts: DataFrame, customer_id=None) -> DataFrame:
    """Contracts of a customer, or of every customer when none is named."""
    if customer_id is not None:
        parties = parties.where(F.col("customer_id") == customer_id)
    return parties.select("customer_id", "contract_id").join(
        contracts.select("contract_id", "contract_number", "activity_status", "effective_date", "expiry_date"),
        "contract_id")


def invoice_chain(contracts: DataFrame, parties: DataFrame, customers: DataFrame, members: DataFrame,
                  accounts: DataFrame, account_billing: DataFrame, billing: DataFrame, invoices: DataFrame,
                  contract_id=None) -> DataFrame:
    """Invoices of a contract over the billing path contract - party - customer - member - account -
    billing account - invoice. The path is reduced to distinct links before invoices are read."""
    if contract_id is not None:
        contracts = contracts.where(F.col("contract_id") == contract_id)
    path = contract_accounts(contracts, parties, customers, members, accounts)
    path = path.join(account_billing.select("account_id", "billing_account_id"), "account_id")
    links = path.join(billing.select("billing_account_id"), "billing_account_id").select("contract_id", "billing_account_id").distinct()
    return links.join(invoices, "billing_account_id")


def contract_accounts(contracts, parties, customers, members, accounts) -> DataFrame:
    """Distinct (contract_id, account_id) links of the billing path."""
    path = contracts.select("contract_id").join(parties.select("contract_id", "customer_id"), "contract_id")
    path = path.join(customers.select("customer_id"), "customer_id").distinct()
    path = path.join(members.select("customer_id", "account_id"), "customer_id")
    return path.join(accounts.select("account_id"), "account_id").select("contract_id", "account_id").distinct()


def reachable_pair_facts(contract_accounts: DataFrame, account_billing: DataFrame, contract_dates: DataFrame,
                         invoices: DataFrame) -> DataFrame:
    """Counts over distinct (contract, invoice) pairs, computed without building a pair.

    contract_accounts: distinct (contract_id, account_id); account_billing: (account_id, billing_account_id);
    contract_dates: (contract_id, effective_date); invoices: (invoice_id, billing_account_id, run_date), each
    invoice in one billing account. Where every billing account belongs to one account the meeting point is the
    account, otherwise the billing account, so that a pair reached twice counts once. Both sides shrink to one
    row per meeting point and day; a running invoice count then gives, for each contract date, the invoices
    before it. No window holds more rows than there are days.
    """
    links = account_billing.select("account_id", "billing_account_id").distinct()
    daily = invoices.groupBy("billing_account_id", F.col("run_date").alias("day")).agg(F.count(F.lit(1)).alias("invoices"))
    shared = not links.groupBy("billing_account_id").count().where("count > 1").isEmpty()
    if shared:
        point = "billing_account_id"
        reach = contract_accounts.join(links, "account_id").select("contract_id", point).distinct()
    else:
        point = "account_id"
        reach = contract_accounts.select("contract_id", point)
        daily = daily.join(links, "billing_account_id").groupBy(point, "day").agg(F.sum("invoices").alias("invoices"))
    starts = reach.join(contract_dates, "contract_id").groupBy(point, F.col("effective_date").alias("day")).agg(
        F.count(F.lit(1)).alias("contracts"))
    none = F.lit(0).cast("long")
    both = daily.select(point, "day", "invoices", none.alias("contracts")).unionByName(
        starts.select(point, "day", none.alias("invoices"), "contracts")).groupBy(point, "day").agg(
        F.sum("invoices").alias("invoices"), F.sum("contracts").alias("contracts"))
    each = Window.partitionBy(point)
    earlier = each.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    facts = both.select("contracts", F.coalesce(F.sum("invoices").over(earlier), F.lit(0)).alias("before"),
                        F.sum("invoices").over(each).alias("all_invoices"))
    pairs = F.sum(F.col("contracts") * F.col("all_invoices"))
    early = F.sum(F.col("contracts") * F.col("before"))
    reached = reach.join(daily.select(point).distinct(), point, "left_semi").agg(
        F.count_distinct("contract_id").alias("contracts_with_invoice"))
    pct = early.cast("decimal(18,0)") * F.lit(Decimal(100)) / F.nullif(pairs, F.lit(0)).cast("decimal(18,0)")
    totals = facts.agg(pairs.alias("pairs"), early.alias("before_effective"), pct.cast("decimal(8,4)").alias("pct_before"))
    return totals.join(F.broadcast(reached))


def pivot_ratio(df: DataFrame, keys: Sequence[str], flag: str, value: str, num: str, den: str,
                out: str = "ratio") -> DataFrame:
    """Ratio of two condition rows of a long table; keys lacking either row are dropped (inner pairing)."""
    wide = df.where(F.col(flag).isin(num, den)).groupBy(*keys).agg(
        F.max(F.when(F.col(flag) == num, F.col(value))).alias("numerator"),
        F.max(F.when(F.col(flag) == den, F.col(value))).alias("denominator"))
    wide = wide.where(F.col("numerator").isNotNull() & F.col("denominator").isNotNull())
    return wide.withColumn(out, F.col("numerator").cast("double") / F.nullif(F.col("denominator").cast("double"), F.lit(0.0)))


def attach_factor_ids(rates: DataFrame, factors: DataFrame, run_id) -> DataFrame:
    """Staged rates with the id of their risk factor of one run."""
    f = factors.where(F.col("derived_from_run_id") == run_id).select(*fixed.FACTOR_KEY, "risk_factor_id")
    return rates.join(broadcast_if_small(f), fixed.FACTOR_KEY)


def active_rate_book(versions: DataFrame, factors: DataFrame, rates: DataFrame) -> DataFrame:
    """Flat rate book of the active version: profile, product_id, base_rate, multiplier."""
    active = ci_active(versions).select("rate_version_id", F.col("created_by_run_id").alias("derived_from_run_id"))
    f = factors.join(F.broadcast(active), "derived_from_run_id")
    return rates.join(f, ["rate_version_id", "risk_factor_id"]).select(
        "rate_version_id", *fixed.FACTOR_KEY, "product_id", "base_rate", "mortality_multiplier")


def ci_active(versions: DataFrame) -> DataFrame:
    """The one active version: latest effective date, then highest id."""
    live = versions.where(R.same_text("status", F.lit("active")))
    return live.agg(F.max_by(F.struct(*versions.columns), F.struct("effective_date", "rate_version_id")).alias("v")
                    ).where("v is not null").select("v.*")


def active_profile_rate(profiles: DataFrame, book: DataFrame, how: str = "inner") -> DataFrame:
    """Profiles with their rate under the given (active) book. The book is broadcast after a size check."""
    return profiles.join(broadcast_if_small(book), [*fixed.FACTOR_KEY, "product_id"], how)


def renewal_context(contracts: DataFrame, applications: DataFrame, enrollments: DataFrame) -> DataFrame:
    """Every contract with its application and enrollment, where it has them."""
    return left_join_spreading_nulls(contracts, applications, "application_id", "contract_id").join(enrollments, "contract_id", "left")


def pinned_per_version(versions: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contracts pinned to each version, zero included; contracts are counted before the join."""
    counts = contracts.groupBy(F.col("issued_rate_version_id").alias("rate_version_id")).agg(
        F.count("contract_id").alias("pinned"))
    return versions.join(counts, "rate_version_id", "left").withColumn("pinned", F.coalesce("pinned", F.lit(0)))


def run_history(runs: DataFrame, states: DataFrame) -> DataFrame:
    """Runs with the source state each observed and a flag whether it retrained."""
    s = states.select(F.col("observed_by_run_id").alias("run_id"), "source_state_id", "content_hash", "byte_size")
    return runs.join(s, "run_id", "left").withColumn("retrained", F.col("source_state_id").isNotNull())


def fk_orphans(tables: Mapping[str, DataFrame], fks: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rows per declared foreign key whose non-null value has no parent.

    Child rows are counted per key value first, so a hot key crosses the shuffle once per task.
    """
    out = None
    for child, column, parent, parent_column in fks:
        values = tables[child].where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(
            F.count(F.lit(1)).alias("_n"))
        missing = values.join(tables[parent].select(F.col(parent_column).alias("_k")), "_k", "left_anti")
        row = missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"),
                          F.min(F.col("_k").cast("string")).alias("example")).select(
            F.lit(f"{child}.{column}").alias("fk"), F.lit(f"{parent}.{parent_column}").alias("parent"),
            "orphans", "example")
        out = row if out is None else out.unionByName(row)
    return out


def zero_cells(grid: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grid cells with no observed row."""
    return grid.join(observed.select(*keys).distinct(), list(keys), "left_anti")


def join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join that fails when a key repeats on either side."""
    keys = list(keys)
    repeated = [f"{side}: {d.groupBy(*keys).count().where('count > 1').limit(1).count()}"
                for side, d in (("left", left), ("right", right))]
    if any(not r.endswith(" 0") for r in repeated):
        raise ValueError(f"join keys {keys} repeat on a side that must be unique")
    return left.join(right, keys, how)


def exists(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right.select(*keys), list(keys), "left_semi")


def not_exists(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right.select(*keys), list(keys), "left_anti")


def profile_grid(spark, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Every combination of fixed vocabularies, built by exploding literal arrays on one row."""
    grid = spark.range(0, 1, 1, 1)
    for name, values in levels.items():
        grid = grid.select("*", F.explode(R.constants(values)).alias(name))
    return grid.drop("id")


def cross_products(factors: DataFrame, products: DataFrame) -> DataFrame:
    """Each risk factor with each product, which is the rate book's shape; products are counted before they are broadcast."""
    return factors.crossJoin(broadcast_if_small(products))


def band_table(spark) -> DataFrame:
    return spark.createDataFrame(fixed.AGE_BANDS, "lower int, upper int, age_band string")


_POSITION = {"date": lambda c: F.unix_date(c).cast("double"), "timestamp": lambda c: c.cast("double")}


def band_join(df: DataFrame, col: str, bands: DataFrame, lower: str = "lower", upper: str = "upper") -> DataFrame:
    """Rows in inclusive bands of any numbers, dates or timestamps; bands may overlap, and a null end is open.

    A band belongs to the power of two that its length does not exceed and is keyed by the bins of that width which it touches, at most two. A row
    is keyed by its bin of each width that the bands have, so a row and a band meet in one bin at most, by equality, and are compared
    exactly there. What a band costs does not depend on its length or kind. Bands with an open end have one key for all.
    """
    place = _POSITION.get(bands.schema[lower].dataType.simpleString(), lambda c: c.cast("double"))
    ends = bands.withColumnsRenamed({lower: "_lower", upper: "_upper"}).withColumns({"_lo": place(F.col("_lower")), "_hi": place(F.col("_upper"))})
    ends = ends.where("_lower is null or _upper is null or _lower <= _upper")
    top = ends.agg(F.max(F.greatest(F.abs("_lo"), F.abs("_hi"), F.lit(1e-300)))).first()[0] or 1.0
    finest = math.ceil(math.log2(top)) - 50          # bins are numbered exactly
    length = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(2.0 ** max(finest, -1000)))
    power = F.when(F.col("_lo").isNotNull() & F.col("_hi").isNotNull(), F.ceil(F.log2(length)).cast("int"))
    keyed = ends.withColumn("_power", F.coalesce(power, F.lit(OPEN)))
    widths = [r[0] for r in keyed.select("_power").distinct().collect()]       # at most one a power of two

    def bins(value: Column, power: Column) -> Column:
        return F.floor(value / F.pow(F.lit(2.0), power)).cast("bigint")

    touched = F.when(F.col("_power") == OPEN, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(bins(F.col("_lo"), F.col("_power")), bins(F.col("_hi"), F.col("_power"))))
    keyed = keyed.withColumn("_bin", F.explode(touched)).drop("_lo", "_hi")
    if not widths:
        return df.join(keyed.drop("_power", "_bin", "_lower", "_upper"), F.lit(False))
    value = place(F.col(col))
    own = F.array(*[F.struct(F.lit(p).alias("_power"), (F.lit(0).cast("bigint") if p == OPEN else bins(value, F.lit(p))).alias("_bin")) for p in widths])
    near = df.where(F.col(col).isNotNull() & ((F.abs(value) <= top) | F.lit(OPEN in widths)))
    if OPEN in widths:      # values beyond all closed bands have only the open ones' key
        own = F.filter(own, lambda x: (x["_power"] == OPEN) | (F.abs(value) <= top))
    rows = near.select("*", F.inline(own))
    inside = (F.col("_lower").isNull() | (F.col("_lower") <= F.col(col))) & (F.col("_upper").isNull() | (F.col(col) <= F.col("_upper")))
    return rows.join(broadcast_if_small(keyed), ["_power", "_bin"]).where(inside).drop("_power", "_bin", "_lower", "_upper")


def bridged_join(fine: DataFrame, coarse: DataFrame, value: str, keys: Sequence[str] = ("gender",)) -> DataFrame:
    """Fine bands take the coarse group's value; a fine band without one raises."""
    mapped = fine.withColumn("coarse_group", R.coarse_group("age_band"))
    joined = mapped.join(coarse.select("coarse_group", *keys, value), ["coarse_group", *keys], "left")
    missing = F.raise_error(F.concat(F.lit("no coarse value for "), F.col("age_band")))
    dtype = coarse.schema[value].dataType
    return joined.withColumn(value, F.when(F.col(value).isNull(), missing.cast(dtype)).otherwise(F.col(value)))


def merge_components(a: DataFrame, b: DataFrame, c: DataFrame, key: str) -> DataFrame:
    """Three files of one respondent set, the first one leading."""
    return a.join(b, key, "left").join(c, key, "left")


def lake_join(lake: DataFrame, staged: DataFrame, lake_cond: Column, staged_cond: Column) -> DataFrame:
    """Lake rows beside the staged rows that satisfy constant predicates (no shared key); the predicates say how many these are."""
    return lake.where(lake_cond).crossJoin(broadcast_if_small(staged.where(staged_cond)))


def external_reference(scores: DataFrame, reference: DataFrame, keys: Sequence[str], score: str, weight: str | None = None) -> DataFrame:
    """Mean score, weighted where a ``weight`` is named, per reference cell beside the reference values."""
    mean = F.sum(F.col(score) * F.col(weight)) / F.sum(F.when(F.col(score).isNotNull(), F.col(weight))) if weight else F.avg(score)
    return scores.groupBy(*keys).agg(mean.alias(f"mean_{score}")).join(reference, list(keys))


def lineage(states: DataFrame, runs: DataFrame, versions: DataFrame, rates: DataFrame,
            contracts: DataFrame) -> DataFrame:
    """Source state to run to version to rates to pinned contracts, one row per version."""
    rate_counts = rates.groupBy("rate_version_id").agg(F.count(F.lit(1)).alias("rates"))
    pinned = contracts.groupBy(F.col("issued_rate_version_id").alias("rate_version_id")).agg(
        F.count(F.lit(1)).alias("contracts"), F.sum("modal_premium").alias("premium"))
    s = states.select("source_state_id", "content_hash", F.col("observed_by_run_id").alias("run_id"))
    v = versions.select("rate_version_id", "effective_date", F.col("created_by_run_id").alias("run_id"))
    return s.join(runs.select("run_id", F.col("status").alias("run_status")), "run_id").join(v, "run_id").join(
        rate_counts, "rate_version_id").join(pinned, "rate_version_id")


def candidates(contracts: DataFrame, enrollments: DataFrame, applications: DataFrame, n: int = 40) -> DataFrame:
    """First n enrolled contracts that have an application."""
    return contracts.join(enrollments.select("contract_id"), "contract_id").join(
        applications.select("application_id"), "application_id").select(
        "contract_id", "contract_number").orderBy("contract_id").limit(n)
