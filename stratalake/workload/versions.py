"""Histories of customers built from what the orders table says on successive days.

A snapshot takes all orders up to its day and holds each customer with the state of the
latest one, unless that is pending.  Between snapshots customers therefore appear,
change, stay, fall away and come back, all by their own data.  The last day is behind
the last order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import versioning as v
from stratalake.session import scratch_path, staged
from stratalake.sinks.versioned import VersionedTable
from stratalake.workload import query
from stratalake.workload.common import iso_dates, table

DAYS = ["1998-06-30", "1999-09-30", "2001-12-31"]
KEY, BUSINESS = "o_custkey", ["status_of_order", "priority", "price"]
OUTPUT = [
    "o_custkey", "status_of_order", "priority", "price", "source_run_id", "version_id",
    "content_hash", "active_from", "active_to", "status", "run_date", "run_id",
]


def snapshot(spark: SparkSession, sf_dir: str, day: str, keys: list[str] | None = None) -> DataFrame:
    """State of each customer, or of each customer and priority, by all orders up to a day.

    A key falls away while its latest order is pending (status P) and comes back with the next
    one that is not.  ``max_by`` keeps one row per key and task before the shuffle, so a customer
    with very many orders is not gathered in one place.
    """
    keys = keys or [KEY]
    end = F.lit(day).cast("date")
    known = table(spark, sf_dir, "orders").filter(F.col("o_orderdate").cast("date") <= end)
    rest = ["o_orderstatus", "o_orderpriority", "o_totalprice"]
    latest = F.max_by(F.struct(*rest), F.struct("o_orderdate", "o_orderkey"))
    return known.groupBy(*keys).agg(latest.alias("l")).filter("l.o_orderstatus <> 'P'").select(
        *keys, F.col("l.o_orderstatus").alias("status_of_order"),
        *([F.col("l.o_orderpriority").alias("priority")] if "o_orderpriority" not in keys else []),
        F.col("l.o_totalprice").alias("price"), F.lit(day).alias("source_run_id"),
    )


def run_id(number: int) -> str:
    return f"run{number}"


def versions(spark: SparkSession, sf_dir: str, runs: list[int]) -> DataFrame:
    """The table after the given runs; run ``n`` loads the snapshot of day ``n``.

    A run starts from the written result of the one before, as runs do; a table
    is read for its open rows and again for its closed ones, so a growing lineage
    would double with every run.
    """
    done: DataFrame | None = None
    for number in runs:
        day = DAYS[min(number, 3) - 1]
        done = staged(v.scd2_apply(
            done, snapshot(spark, sf_dir, day), KEY, BUSINESS, day, run_id(number)
        ), "versions")
    return done


def snapshots_sql(keys: str = "o_custkey", priority: str = "o_orderpriority AS priority,") -> str:
    """CTEs ``runs`` and ``s``: the snapshots with their hashes, by run number."""
    hashed = ["coalesce(status_of_order, '')"]
    if priority:
        hashed.append("coalesce(priority, '')")
    hashed.append("CAST(CAST(price AS DECIMAL(38,6)) AS VARCHAR)")
    days = ", ".join(f"({i}, DATE '{d}')" for i, d in enumerate(DAYS, 1))
    return f"""
runs AS (SELECT * FROM (VALUES {days}) AS t(run, day)),
latest AS (
  SELECT run, day, {keys}, o_orderstatus AS status_of_order, {priority} o_totalprice AS price
  FROM orders, runs
  WHERE CAST(o_orderdate AS DATE) <= day
  QUALIFY row_number() OVER (PARTITION BY run, {keys} ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
s AS (SELECT *, md5(concat_ws('|', {', '.join(hashed)})) AS h FROM latest WHERE status_of_order <> 'P')
"""


def history_sql(last_run: int, keys: str = "o_custkey", priority: str = "o_orderpriority AS priority,") -> str:
    """CTE ``hist``: every version after ``last_run`` runs, found without replaying them."""
    columns = [k.strip() for k in keys.split(",")]
    same = " AND ".join(f"p.{k} = s.{k}" for k in columns)
    key_text = " || '|' || ".join(f"CAST(s.{k} AS VARCHAR)" for k in columns)
    hold = " AND ".join(f"x.{k} = s.{k}" for k in columns)
    held = "".join(
        f"LEFT JOIN s x{r} ON x{r}.run = {r} AND x{r}.h = s.h AND {hold.replace('x.', f'x{r}.')}\n"
        for r in range(2, last_run + 1)
    )
    closing = "CASE " + " ".join(
        f"WHEN s.run < {r} AND x{r}.run IS NULL THEN {r}" for r in range(2, last_run + 1)
    ) + " END" if last_run > 1 else "NULL"
    return f"""{snapshots_sql(keys, priority)},
opened AS (
  SELECT s.*, {closing} AS close_run,
    md5({key_text} || '|' || strftime(s.day, '%Y-%m-%d') || '|' || s.h || '|run' || s.run) AS vid
  FROM s LEFT JOIN s p ON p.run = s.run - 1 AND {same} AND p.h = s.h
  {held}
  WHERE p.run IS NULL AND s.run <= {last_run}),
hist AS (
  SELECT {', '.join('o.' + k for k in columns)}, o.status_of_order, {'o.priority,' if priority else ''} o.price,
    strftime(o.day, '%Y-%m-%d') AS source_run_id,
    substr(vid, 1, 8) || '-' || substr(vid, 9, 4) || '-' || substr(vid, 13, 4) || '-' || substr(vid, 17, 4)
      || '-' || substr(vid, 21, 12) AS version_id,
    o.h AS content_hash, strftime(o.day, '%Y-%m-%d') AS active_from,
    coalesce(strftime(c.day, '%Y-%m-%d'), '9999-12-31') AS active_to,
    CASE WHEN c.day IS NULL THEN 'current' ELSE 'historical' END AS status,
    strftime(coalesce(c.day, o.day), '%Y-%m-%d') AS run_date,
    'run' || coalesce(c.run, o.run) AS run_id
  FROM opened o LEFT JOIN runs c ON c.run = o.close_run)
"""


@query("scd2_initial", f"WITH {history_sql(1)} SELECT * FROM hist")
def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(versions(spark, sf_dir, [1]).select(*OUTPUT))


@query("scd2_update", f"WITH {history_sql(2)} SELECT * FROM hist")
def scd2_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(versions(spark, sf_dir, [1, 2]).select(*OUTPUT))


@query("scd2_return", f"WITH {history_sql(3)} SELECT * FROM hist")
def scd2_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third run: customers who fell away earlier come back."""
    return iso_dates(versions(spark, sf_dir, [1, 2, 3]).select(*OUTPUT))


@query("scd2_expire", f"""WITH {history_sql(3)}
SELECT o_custkey, active_from, active_to FROM hist h WHERE status = 'historical'
  AND NOT EXISTS (SELECT 1 FROM s WHERE s.o_custkey = h.o_custkey AND strftime(s.day, '%Y-%m-%d') = h.active_to)
""")
def scd2_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed versions without a successor on the day they were closed."""
    done = versions(spark, sf_dir, [1, 2, 3])
    opened = done.select(KEY, F.col("active_from").alias("active_to"))
    return iso_dates(
        done.filter(F.col("status") == v.HISTORICAL)
        .join(opened, [KEY, "active_to"], "left_anti").select(KEY, "active_from", "active_to")
    )


@query("scd2_rerun", f"WITH {history_sql(3)} SELECT * FROM hist")
def scd2_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third snapshot loaded twice leaves what it left the first time."""
    return iso_dates(versions(spark, sf_dir, [1, 2, 3, 4]).select(*OUTPUT))


@query("scd2_composite", f"""WITH {history_sql(2, 'o_custkey, o_orderpriority', '')}
SELECT * FROM hist""")
def scd2_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["o_custkey", "o_orderpriority"]
    done = None
    for number, day in enumerate(DAYS[:2], 1):
        done = staged(v.scd2_apply(
            done, snapshot(spark, sf_dir, day, keys), keys,
            ["status_of_order", "price"], day, run_id(number),
        ), "versions")
    names = [c for c in OUTPUT if c not in ("o_custkey", "priority")]
    return iso_dates(done.select(*keys, *names))


CHANGES_SQL = f"""{snapshots_sql()},
c AS (SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
    CASE WHEN a.run IS NULL THEN 'NEW' WHEN b.run IS NULL THEN 'EXPIRED'
         WHEN a.h = b.h THEN 'UNCHANGED' ELSE 'CHANGED' END AS change
  FROM (SELECT * FROM s WHERE run = 1) a FULL JOIN (SELECT * FROM s WHERE run = 2) b
    ON a.o_custkey = b.o_custkey)
"""


@query("scd2_classify", f"WITH {CHANGES_SQL} SELECT * FROM c")
def scd2_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = versions(spark, sf_dir, [1])
    matched = v.match_versions(
        first, snapshot(spark, sf_dir, DAYS[1]), KEY, BUSINESS, with_rows=False
    )
    return matched.select(KEY, "change")


@query("scd2_stats", f"""WITH {CHANGES_SQL},
n AS (SELECT count(*) FILTER (change = 'NEW') AS new, count(*) FILTER (change = 'CHANGED') AS changed,
  count(*) FILTER (change = 'EXPIRED') AS expired, count(*) FILTER (change = 'UNCHANGED') AS unchanged FROM c)
SELECT *, new + 2 * changed + expired AS total_written,
  round(100.0 * (1 - CAST(new + 2 * changed + expired AS DOUBLE) / (2.0 * (new + changed + unchanged))), 1) AS write_reduction_pct
FROM n""")
def scd2_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = versions(spark, sf_dir, [1])
    return v.change_stats(v.match_versions(
        first, snapshot(spark, sf_dir, DAYS[1]), KEY, BUSINESS, with_rows=False
    ))


@query("scd2_rejects", """
WITH k AS (SELECT nullif(o_orderpriority, '5-LOW') AS p, o_custkey, o_orderkey FROM orders),
n AS (SELECT *, count(*) OVER (PARTITION BY p, o_custkey) AS c FROM k)
SELECT o_orderkey, CASE WHEN p IS NULL OR c > 1 THEN 'rejected' ELSE 'usable' END AS verdict FROM n
""")
def scd2_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite keys of which some are NULL and some repeat."""
    rows = table(spark, sf_dir, "orders").select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"), "o_custkey", "o_orderkey"
    )
    usable, rejected = v.split_bad_keys(rows, ["p", "o_custkey"])
    return usable.select("o_orderkey", F.lit("usable").alias("verdict")).unionByName(
        rejected.select("o_orderkey", F.lit("rejected").alias("verdict"))
    )


@query("scd2_as_of", f"""WITH {history_sql(3)}
SELECT * FROM hist WHERE active_from <= '{DAYS[1]}' AND '{DAYS[1]}' < active_to""")
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(v.as_of(versions(spark, sf_dir, [1, 2, 3]), DAYS[1]).select(*OUTPUT))


@query("scd2_as_of_closed", f"""WITH {history_sql(3)}
SELECT * FROM hist WHERE '{DAYS[1]}' BETWEEN active_from AND active_to""")
def scd2_as_of_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = versions(spark, sf_dir, [1, 2, 3])
    return iso_dates(v.as_of(done, DAYS[1], "closed").select(*OUTPUT))


@query("scd2_history", f"""WITH {history_sql(3)}
SELECT o_custkey, version_id, active_from, active_to, status,
  CASE WHEN active_to = '9999-12-31' THEN 'CURRENT' ELSE 'EXPIRED' END AS version_status
FROM hist WHERE o_custkey IN (SELECT o_custkey FROM hist GROUP BY 1 HAVING count(*) > 1)""")
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the keys that have more than one; the key list is a semi-join."""
    done = versions(spark, sf_dir, [1, 2, 3])
    several = done.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chosen = done.join(several, KEY, "left_semi")
    return iso_dates(v.history(chosen, F.lit(True)).select(
        KEY, "version_id", "active_from", "active_to", "status", "version_status"
    ))


@query("scd2_changes", f"""WITH {history_sql(3)}
SELECT * FROM hist WHERE run_date = '{DAYS[1]}'
  AND (active_from = '{DAYS[1]}' OR (active_to = '{DAYS[1]}' AND active_to < '9999-12-31'))""")
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(v.changes_on(versions(spark, sf_dir, [1, 2, 3]), DAYS[1]).select(*OUTPUT))


@query("scd2_discontinued", f"""WITH {history_sql(3)}
SELECT o_custkey, active_to AS discontinued_date FROM hist
WHERE active_to >= strftime(DATE '2002-01-15' - 30, '%Y-%m-%d') AND active_to < '9999-12-31' AND status = 'historical'""")
def scd2_discontinued(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = v.discontinued(versions(spark, sf_dir, [1, 2, 3]), "2002-01-15", 30)
    return iso_dates(closed.select(KEY, F.col("active_to").alias("discontinued_date")))


@query("scd2_actions", f"""WITH {history_sql(2)}
SELECT o_custkey, CASE WHEN bool_or(status = 'current') AND bool_or(status <> 'current') THEN 'UPDATE'
   WHEN bool_or(status = 'current') THEN 'INSERT' ELSE 'DELETE' END AS action
FROM hist WHERE run_id = 'run2' GROUP BY o_custkey""")
def scd2_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = versions(spark, sf_dir, [1, 2])
    return v.batch_actions(v.changes_on(done, DAYS[1]), KEY)


@query("scd2_evolve", f"""WITH {snapshots_sql()},
a AS (SELECT * FROM s WHERE run = 1),
e AS (SELECT *, CASE WHEN status_of_order = 'F' THEN 'late' END AS note FROM a)
SELECT a.o_custkey, CAST(NULL AS VARCHAR) AS note, 'historical' AS status, '{DAYS[0]}' AS active_from, '{DAYS[1]}' AS active_to
FROM a WHERE status_of_order = 'F'
UNION ALL
SELECT o_custkey, note, 'current', CASE WHEN note IS NULL THEN '{DAYS[0]}' ELSE '{DAYS[1]}' END, '9999-12-31' FROM e""")
def scd2_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column is added; only rows that have a value in it change."""
    first = versions(spark, sf_dir, [1])
    wider = snapshot(spark, sf_dir, DAYS[0]).withColumn(
        "note", F.when(F.col("status_of_order") == "F", "late")
    )
    done = v.scd2_apply(first, wider, KEY, [*BUSINESS, "note"], DAYS[1], "run2")
    return iso_dates(done.select(KEY, "note", "status", "active_from", "active_to"))


@query("status_summary", f"""WITH {history_sql(3)}
SELECT status, count(*) AS record_count, count(DISTINCT o_custkey) AS unique_keys FROM hist GROUP BY status""")
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.status_summary(versions(spark, sf_dir, [1, 2, 3]), KEY)


def stored_table(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> VersionedTable:
    """The three snapshots and one repeated run, loaded into a stored table."""
    path = scratch_path(spark, "versions")
    name = "versions_" + path.rsplit("-", 1)[1] if buckets else None
    stored = VersionedTable(spark, path, KEY, BUSINESS, buckets, name)
    for number, day in enumerate([DAYS[0], DAYS[1], DAYS[1], DAYS[2]], 1):
        run = run_id({1: 1, 2: 2, 3: 2, 4: 3}[number])
        stored.apply(snapshot(spark, sf_dir, day), day, run)
    return stored


@query("versioned_table", f"WITH {history_sql(3)} SELECT * FROM hist")
def versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(stored_table(spark, sf_dir).read().select(*OUTPUT))


@query("versioned_table_bucketed", f"WITH {history_sql(3)} SELECT * FROM hist")
def versioned_table_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(stored_table(spark, sf_dir, buckets=8).read().select(*OUTPUT))


@query("version_readback", f"WITH {history_sql(2)} SELECT * FROM hist")
def version_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was after its second load."""
    return iso_dates(stored_table(spark, sf_dir).read(version=2).select(*OUTPUT))


@query("commit_log", f"""WITH {snapshots_sql()},
pairs AS (SELECT r.run, coalesce(a.o_custkey, b.o_custkey) AS k, a.h AS old, b.h AS new
  FROM runs r JOIN s b ON b.run = r.run LEFT JOIN s a ON a.run = r.run - 1 AND a.o_custkey = b.o_custkey
  UNION ALL
  SELECT r.run, a.o_custkey, a.h, NULL FROM runs r JOIN s a ON a.run = r.run - 1
  WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.run = r.run AND b.o_custkey = a.o_custkey))
SELECT CAST(run AS INTEGER) AS version, 'run' || run AS run_id, count(*) FILTER (old IS NULL) AS new,
  count(*) FILTER (old <> new) AS changed, count(*) FILTER (new IS NULL) AS expired,
  count(*) FILTER (old = new) AS unchanged
FROM pairs GROUP BY run""")
def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics per load; the repeated run left no commit."""
    return stored_table(spark, sf_dir).commits().select(
        "version", "run_id", "new", "changed", "expired", "unchanged"
    )


@query("rows_written", f"""WITH {CHANGES_SQL},
n AS (SELECT run AS version, count(*) AS written FROM s WHERE run = 1 GROUP BY run)
SELECT CAST(version AS INTEGER) AS version, written FROM n
UNION ALL
SELECT 2, count(*) FILTER (change = 'NEW') + 2 * count(*) FILTER (change = 'CHANGED') + count(*) FILTER (change = 'EXPIRED') FROM c""")
def rows_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the files of the first two loads: a load writes what it changes, no more."""
    stored = VersionedTable(spark, scratch_path(spark, "versions"), KEY, BUSINESS)
    for number, day in enumerate(DAYS[:2], 1):
        stored.apply(snapshot(spark, sf_dir, day), day, run_id(number))
    return stored.rows_written()


def hashed_lists(spark: SparkSession, sf_dir: str, lists: list[list[str]]) -> DataFrame:
    """One snapshot loaded on successive days, each time with other columns hashed."""
    stored = VersionedTable(spark, scratch_path(spark, "versions"), KEY, lists[0])
    for number, (day, columns) in enumerate(zip(DAYS, lists), 1):
        stored.business_columns = columns
        stored.apply(snapshot(spark, sf_dir, DAYS[0]), day, run_id(number))
    return iso_dates(stored.read().select(KEY, "status", "active_from", "active_to"))


_NEVER_CHANGED = f"WITH {history_sql(1)} SELECT o_custkey, status, active_from, active_to FROM hist"


@query("scd2_hash_list_grows", _NEVER_CHANGED)
def scd2_hash_list_grows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored column joins the hashed ones: nothing has changed."""
    return hashed_lists(spark, sf_dir, [BUSINESS[:2], BUSINESS, BUSINESS])


@query("scd2_hash_list_shrinks", _NEVER_CHANGED)
def scd2_hash_list_shrinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column leaves the hashed ones: nothing has changed."""
    return hashed_lists(spark, sf_dir, [BUSINESS, BUSINESS[:2], BUSINESS[:2]])


WHOLE_SQL = f"WITH {history_sql(3)} SELECT * FROM hist"


@query("scd2_whole", WHOLE_SQL)
def scd2_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions by snapshots that take all orders up to their day."""
    return iso_dates(versions(spark, sf_dir, [1, 2, 3]).select(*OUTPUT))


def whole_stored(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    path = scratch_path(spark, "versions")
    name = "versions_" + path.rsplit("-", 1)[1] if buckets else None
    stored = VersionedTable(spark, path, KEY, BUSINESS, buckets, name)
    for number, day in enumerate(DAYS, 1):
        stored.apply(snapshot(spark, sf_dir, day), day, run_id(number))
    return stored.read()


@query("versioned_table_whole", WHOLE_SQL)
def versioned_table_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(whole_stored(spark, sf_dir).select(*OUTPUT))


@query("versioned_table_whole_bucketed", WHOLE_SQL)
def versioned_table_whole_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iso_dates(whole_stored(spark, sf_dir, buckets=8).select(*OUTPUT))
