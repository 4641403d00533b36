"""Mixed timestamp formats and time zones: one UTC instant per message.

Method: an account's offset history is estimated by aligning its zoneless local times with the times at
which their rows were loaded.  Each such row, being loaded within minutes of its writing unless it is
late, implies one quarter-hour offset; the candidate history (IANA zone and day/month order) that the
fewest rows violate is chosen, then the local times are converted by it.  Late rows imply scattered
offsets, which violate all candidates alike.  The declared zone is one of the candidates; it stands
unless another violates materially fewer rows, so a wrong or missing declaration is repaired while
noise cannot overturn a right one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import timestamps as T
from threadloom.session import cut_lineage, small

# One zone for each widespread offset history, the candidates beside the declared zones.
CANDIDATE_ZONES = [
    "UTC", "Europe/London", "Europe/Lisbon", "Europe/Berlin", "Europe/Helsinki", "Europe/Moscow", "Europe/Istanbul",
    "Africa/Cairo", "Africa/Johannesburg", "Africa/Lagos", "Africa/Nairobi", "Asia/Dubai", "Asia/Karachi", "Asia/Kolkata",
    "Asia/Kathmandu", "Asia/Dhaka", "Asia/Bangkok", "Asia/Shanghai", "Asia/Tokyo", "Australia/Brisbane", "Australia/Sydney",
    "Australia/Adelaide", "Pacific/Auckland", "America/Sao_Paulo", "America/Argentina/Buenos_Aires", "America/Santiago",
    "America/Halifax", "America/New_York", "America/Chicago", "America/Denver", "America/Phoenix", "America/Los_Angeles",
    "America/Anchorage", "Pacific/Honolulu", "America/Mexico_City", "America/Bogota",
]
CANONICAL = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"  # "$" would let a line end pass


def accounts_frame(accounts: DataFrame) -> DataFrame:
    """``account_id, zone, date_order``, one row per account: of repeated rows the smallest values."""
    return (
        accounts.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(F.min(T.known_zone(F.col("zone"))).alias("zone"), F.min(F.lower("date_order")).alias("date_order"))
    )


def estimate_histories(parsed: DataFrame, accounts: DataFrame, margin: float = 0.1, quantum_s: int = 900) -> DataFrame:
    """The offset history of each account: ``account_id, zone, date_order, n_rows, n_violations``.

    ``parsed`` has ``account_id, p`` (parsed fields) and ``loaded_at``.  Rows are first counted by account,
    local day and implied offset, which bounds what meets the candidates, whatever the number of rows (the
    offset of noon stands for the day, so a few rows on the days of a clock change may count as violations).
    Another history replaces the declared one only if it violates fewer rows by ``margin`` of them all.
    Accounts without any zoneless row, and null accounts, are left out.
    """
    spark = parsed.sparkSession
    bare = F.col("p.zone").isNull() & F.col("p.epoch_us").isNull() & F.col("p.family").isNotNull()
    rows = parsed.where(bare & F.col("account_id").isNotNull() & F.col("loaded_at").isNotNull())
    both = F.explode(F.array(*[F.struct(F.lit(o).alias("o"), T.wall_clock(F.col("p"), F.lit(o)).alias("wall")) for o in ("dmy", "mdy")]))
    rows = rows.select("account_id", "loaded_at", both.alias("w")).select("account_id", "loaded_at", "w.*")
    loaded = F.unix_micros("loaded_at") / 1_000_000
    implied = (F.ceil((T.ntz_seconds(F.col("wall")) - loaded) / quantum_s) * quantum_s).cast("long")
    counted = (
        rows.groupBy("account_id", "o", F.col("wall").cast("date").alias("day"), F.when(F.abs(implied) <= 15 * 3600, implied).alias("implied"))
        .agg(F.count("*").alias("n"))
    )
    counted = cut_lineage(counted.where("day is not null"))
    zones = spark.createDataFrame([(z,) for z in CANDIDATE_ZONES], "zone string").union(
        accounts.select("zone").where(F.col("zone").isNotNull())
    ).distinct()
    noon = (F.col("day").cast("timestamp_ntz") + F.expr("interval 12 hours"))
    # The zones are a fixed list and those of the accounts, 600 at most; the days are those of the calendar.
    history = counted.select("day").distinct().crossJoin(F.broadcast(zones)).select(
        "day", "zone", (T.ntz_seconds(noon) - T.to_utc_seconds(noon, F.col("zone"))).alias("implied")
    )
    total = counted.groupBy("account_id", "o").agg(F.sum("n").alias("n_rows"))
    fitting = counted.join(history, ["day", "implied"]).groupBy("account_id", "o", "zone").agg(F.sum("n").alias("fit"))
    scored = (
        total.crossJoin(F.broadcast(zones))
        .join(fitting, ["account_id", "o", "zone"], "left")
        .select("account_id", "o", "zone", "n_rows", (F.col("n_rows") - F.coalesce("fit", F.lit(0))).alias("n_violations"))
    )
    declared = accounts.select("account_id", F.col("zone").alias("zone0"), F.col("date_order").alias("order0"))
    fits_zone = F.col("zone0").isNull() | (F.col("zone0") == F.col("zone"))
    fits_order = F.col("order0").isNull() | (F.col("order0") == F.col("o"))
    cost = F.col("n_violations") + F.when(fits_zone & fits_order, 0.0).otherwise(F.col("n_rows") * F.lit(margin))
    best = Window.partitionBy("account_id").orderBy(F.col("cost"), F.col("zone"), F.col("o"))
    return (
        scored.join(declared, "account_id", "left")
        .withColumn("cost", cost)
        .withColumn("k", F.row_number().over(best))
        .where("k = 1")
        .select("account_id", "zone", F.col("o").alias("date_order"), "n_rows", "n_violations")
    )


def row_instants(messages: DataFrame, accounts: DataFrame, estimate: bool = True) -> DataFrame:
    """``messages`` (all columns) with ``utc_us`` and ``is_canonical``; null where a text denotes no instant.

    Null, blank and useless timestamps give null.  Rows of unknown accounts have instants only where the
    text states its zone, or where the account's history can be estimated.  Empty tables give empty ones.
    """
    known = accounts_frame(accounts)
    parsed = messages.withColumn("__p", T.parse_fields(F.col("timestamp")))
    if estimate:
        parsed = cut_lineage(parsed)  # read twice; parsing costs more than the file
        found = estimate_histories(parsed.select("account_id", "loaded_at", F.col("__p").alias("p")), known)
        used = cut_lineage(
            known.join(found.select("account_id", F.col("zone").alias("z"), F.col("date_order").alias("o")), "account_id", "full")
            .select("account_id", F.coalesce("z", "zone").alias("__zone"), F.coalesce("o", "date_order").alias("__order"))
        )
    else:
        used = known.select("account_id", F.col("zone").alias("__zone"), F.col("date_order").alias("__order"))
    return (
        parsed.join(small(used), "account_id", "left")  # accounts are mailboxes and exports, few beside their messages
        .withColumn("utc_us", T.instant_us(F.col("__p"), F.col("__zone"), F.coalesce(F.col("__order"), F.lit("dmy"))))
        .withColumn("is_canonical", F.coalesce(F.col("timestamp").rlike(CANONICAL), F.lit(False)))
        .drop("__p", "__zone", "__order")
    )


def message_instants(messages: DataFrame, accounts: DataFrame, estimate: bool = True, keep: list[str] = ()) -> DataFrame:
    """One row per message: ``message_id, utc_us, all_canonical`` and the columns of ``keep``.

    Copies of a message denote one instant at different precision (digits are only ever cut off), so the
    latest reading is the most precise.  ``utc_us`` is null where no copy denotes an instant.  Copies agree
    in the columns of ``keep``; where they do not, the smallest value is kept.
    """
    rows = row_instants(messages.select("message_id", "account_id", "timestamp", "loaded_at", *keep), accounts, estimate)
    return (
        rows.where(F.col("message_id").isNotNull())
        .groupBy("message_id")
        .agg(F.max("utc_us").alias("utc_us"), F.bool_and("is_canonical").alias("all_canonical"), *[F.min(c).alias(c) for c in keep])
    )
