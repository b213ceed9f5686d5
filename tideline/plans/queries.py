"""Every operator as a query over whole tables, and the SQL that must give the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import avro, naming, temporal
from ..functions.tagged_json import json_column
from ..operators import compact, log, messages, transactions
from ..policy import ErrorPolicy, apply_policy, dead_letters, row_fault
from ..sources import catalog as cat
from ..sources import changelog
from ..sources.catalog import Table
from ..sources.snapshot import encoded_snapshot, export, snapshot_log
from ..streaming import compaction
from ..streaming.replicate import Job, follow
from ..streaming.sinks import FolderSink
from .inputs import (
    BY_NAME, CLASSES, EVENTS_RELID, INDEXES, LSNS, NAMES, NAMESPACES, SCHEMA_EVENTS, TABLES,
    acknowledged, catalog, encoded_events, event_log, log_of_events, mutable_key_log, schema_events, table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def values(rows) -> str:
    """A SQL VALUES list."""

    def one(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "true" if x else "false"
        return str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


L1 = """l1 AS (SELECT event_id + 1 AS lsn, 0 AS seq, event_id // 10 + 1 AS xid,
  CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS kind,
  event_id, user_id, event_type, value, props FROM events)"""
L2 = """l2 AS (SELECT event_id + 1 AS lsn, event_id, user_id, event_type,
  lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS old_type,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events)"""
SPLIT = """split AS (
  SELECT lsn, 0 AS seq, 'delete' AS kind, user_id, old_type AS event_type, NULL::BIGINT AS event_id FROM l2 WHERE old_type <> event_type
  UNION ALL SELECT lsn, 1, 'insert', user_id, event_type, event_id FROM l2 WHERE old_type <> event_type
  UNION ALL SELECT lsn, 0, CASE WHEN nth = 1 THEN 'insert' ELSE 'update' END, user_id, event_type, event_id
            FROM l2 WHERE nth = 1 OR old_type = event_type)"""


# ---------------------------------------------------------------- snapshots


def _flat(logged: DataFrame, columns: list[str]) -> DataFrame:
    return logged.select("lsn", "xid", "kind", "relid", "namespace", "table_name", *[F.col(f"new.{c}").alias(c) for c in columns])


def _snapshot_sql(name: str, columns: str) -> str:
    return f"""SELECT 0::BIGINT AS lsn, 0::BIGINT AS xid, 'insert' AS kind, {BY_NAME[name].relid}::BIGINT AS relid,
      'public' AS namespace, '{name}' AS table_name, {columns} FROM {name}"""


@query(_snapshot_sql("nation", "n_nationkey, n_name, n_regionkey"))
def snapshot_nation(spark, sf_dir):
    df = table(spark, sf_dir, "nation")
    return _flat(snapshot_log(df, BY_NAME["nation"]), df.columns)


@query(_snapshot_sql("orders", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"))
def snapshot_orders(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return _flat(snapshot_log(df, BY_NAME["orders"]), df.columns)


@query(" UNION ALL ".join(
    f"SELECT {t.relid}::BIGINT AS relid, '{t.name}' AS table_name, count(*) AS n_rows, "
    f"{'count(*)' if t.key else '0::BIGINT'} AS keyed_rows FROM {t.name}" for t in TABLES))  # fmt: skip
def snapshot_all_counts(spark, sf_dir):
    logs = [snapshot_log(table(spark, sf_dir, t.name), t).select("relid", "table_name", F.lit(bool(t.key)).alias("keyed")) for t in TABLES]
    return reduce(DataFrame.unionByName, logs).groupBy("relid", "table_name").agg(
        F.count("*").alias("n_rows"), F.count(F.when(F.col("keyed"), 1)).alias("keyed_rows")
    )


@query(" UNION ALL ".join(f"SELECT '{t.name}' AS table_name, count(*) AS n_rows, count(*) AS n_positions FROM {t.name}" for t in TABLES))
def snapshot_positions(spark, sf_dir):
    """No two rows of a snapshot share a position, equal rows included."""
    logs = [snapshot_log(table(spark, sf_dir, t.name), t).select("table_name", "lsn", "seq") for t in TABLES]
    rows = reduce(DataFrame.unionByName, [x.groupBy("table_name", "lsn", "seq").count() for x in logs])
    return rows.groupBy("table_name").agg(F.sum("count").alias("n_rows"), F.count("*").alias("n_positions"))


@query(" UNION ALL ".join(
    f"SELECT '{t.name}' AS table_name, count(*) AS n_rows, "
    + (f"count(DISTINCT ({', '.join(t.key)}))" if t.key else "0::BIGINT") + f" AS n_keys FROM {t.name}" for t in TABLES))
def export_tables(spark, sf_dir):
    """All tables, one of them unkeyed, exported into one stream of encoded rows."""
    out = export(lambda n: table(spark, sf_dir, n), list(TABLES), "json", allow_unkeyed=True)
    return out.groupBy("table_name").agg(F.count("*").alias("n_rows"), F.countDistinct("key").alias("n_keys"))


# ---------------------------------------------------------------- catalog

_CATALOG = f"""class(oid, ns, relname, relkind, ident, persist) AS (VALUES {values(CLASSES)}),
namespace(oid, nspname) AS (VALUES {values(NAMESPACES)}),
idx(indexrelid, indrelid, isprim, isident, valid, ready) AS (VALUES {values(INDEXES)}),
found AS (SELECT c.oid::BIGINT AS relid, n.nspname AS namespace, c.relname AS table_name, c.ident AS identity,
  i.indexrelid::BIGINT AS key_index_id, ic.relname AS key_index
  FROM class c JOIN namespace n ON c.ns = n.oid
  LEFT JOIN idx i ON c.oid = i.indrelid AND i.valid AND i.ready
    AND ((c.ident IN ('d', 'f') AND i.isprim) OR (c.ident = 'i' AND i.isident))
  LEFT JOIN class ic ON i.indexrelid = ic.oid
  WHERE c.relkind = 'r' AND c.persist = 'p' AND n.nspname NOT LIKE 'pg_%' AND n.nspname <> 'information_schema')"""


@query(f"WITH {_CATALOG} SELECT relid, namespace, table_name, identity, coalesce(key_index_id, 0) AS key_index_id, key_index FROM found")
def catalog_keys(spark, sf_dir):
    """0 stands for no key index."""
    return cat.discover(*catalog(spark)).fillna(0, ["key_index_id"])


@query(f"""WITH {_CATALOG} SELECT relid, namespace, table_name,
  CASE WHEN identity = 'n' THEN 'replica identity is NOTHING' ELSE 'no primary key' END AS reason FROM found WHERE key_index_id IS NULL""")
def catalog_unkeyed(spark, sf_dir):
    return cat.unkeyed(cat.discover(*catalog(spark)))


# ---------------------------------------------------------------- messages


@query(f"""WITH {L1} SELECT 'events' AS topic, user_id AS key, CASE WHEN kind = 'delete' THEN NULL ELSE props END AS value,
  xid, lsn, seq FROM l1""")
def messages_upsert_tombstone(spark, sf_dir):
    return messages.to_messages(event_log(spark, sf_dir), F.col("user_id"), F.col("props"), F.lit("events"))


@query("SELECT 'lineitem' AS topic, NULL::VARCHAR AS key, 0::BIGINT AS xid, 0::BIGINT AS lsn, lineitem.* FROM lineitem")
def messages_unkeyed(spark, sf_dir):
    logged = snapshot_log(table(spark, sf_dir, "lineitem"), BY_NAME["lineitem"])
    out = messages.to_messages(logged, F.lit(None).cast("string"), F.col("new"), F.lit("lineitem"))
    return messages.deduplicate(out).select("topic", "key", "xid", "lsn", "value.*")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, count(*) AS copies FROM lineitem GROUP BY ALL""")
def snapshot_messages_unkeyed(spark, sf_dir):
    """An unkeyed table through the replication job into a folder and back: no row is lost, equal ones included."""
    work = work_folder(spark)
    sink = FolderSink(f"{work}/topics")
    Job(sink, f"{work}/checkpoint", form="json", allow_unkeyed=True).snapshot(lambda n: table(spark, sf_dir, n), [BY_NAME["lineitem"]])
    part = lambda c, kind, to: F.get_json_object("value", f"$.{c}.{kind}").cast(to).alias(c)
    longs = [part(c, "long", "long") for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    texts = [part(c, "string", "string") for c in ("l_returnflag", "l_linestatus")]
    rows = sink.read(spark).select(*longs, part("l_linenumber", "int", "int"), *texts)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))


@query("SELECT p::INTEGER AS partition, true AS fair FROM range(8) t(p)")
def unkeyed_spread(spark, sf_dir):
    """Rows without a key spread over the partitions: each has its share, within a fifth."""
    logged = snapshot_log(table(spark, sf_dir, "lineitem"), BY_NAME["lineitem"])
    sent = messages.to_messages(logged, F.lit(None).cast("string"), F.col("new.l_orderkey"), F.lit("lineitem"), 8)
    counts = sent.groupBy("partition").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    return counts.select("partition", F.col("n").between(total / 8 * 0.8, total / 8 * 1.2).alias("fair"))


@query(f"WITH {L1} SELECT kind, count(*) AS n FROM l1 WHERE kind <> 'delete' GROUP BY 1")
def messages_unkeyed_deletes(spark, sf_dir):
    """A log without keys: deletes give no message."""
    logged = event_log(spark, sf_dir)
    out = messages.to_messages(logged, F.lit(None).cast("string"), F.col("kind"), F.lit("events"))
    return out.groupBy(F.col("value").alias("kind")).agg(F.count("*").alias("n"))


@query(f"""WITH {L1} SELECT lsn, seq, kind || ' events key=' || user_id || CASE WHEN kind = 'update' THEN ' old=u' || user_id ELSE '' END
    || CASE WHEN kind <> 'delete' THEN ' new=' || event_type ELSE '' END AS line FROM l1
  UNION ALL SELECT min(lsn), -1, 'begin xid=' || xid FROM l1 GROUP BY xid UNION ALL SELECT max(lsn), 9, 'commit xid=' || xid FROM l1 GROUP BY xid
  UNION ALL SELECT 0, 0, 'schema events'""")
def debug_print(spark, sf_dir):
    """A line for every kind of event: brackets, schemas, rows with old and new."""
    rows = event_log(spark, sf_dir)
    xids = rows.groupBy("xid").agg(F.min("lsn").alias("a"), F.max("lsn").alias("z"))
    begin = xids.select("xid", F.col("a").alias("lsn"), F.lit(-1).alias("seq"), F.lit("begin").alias("kind"))
    commit = xids.select("xid", F.col("z").alias("lsn"), F.lit(9).alias("seq"), F.lit("commit").alias("kind"))
    schema = spark.createDataFrame([(0, 0, 0, "schema")], "xid long, lsn long, seq int, kind string")
    for more in (begin, commit, schema):
        rows = rows.unionByName(more, allowMissingColumns=True)
    old = F.when(F.col("kind") == "update", F.concat(F.lit("u"), "user_id"))
    new = F.when(F.col("kind") != "delete", F.col("event_type"))
    return messages.debug_lines(rows, F.lit("events"), F.col("user_id").cast("string"), old, new)


# ---------------------------------------------------------------- compaction and splitting

_COMPACT = f"""WITH {L1} SELECT user_id, arg_max(event_id, lsn) AS event_id, arg_max(event_type, lsn) AS event_type,
  arg_max(value, lsn) AS value FROM l1 GROUP BY user_id HAVING arg_max(kind, lsn) <> 'delete'"""


@query(_COMPACT)
def compact_latest(spark, sf_dir):
    logged = event_log(spark, sf_dir)
    return compact.latest(logged, ["user_id"], log.position(), F.col("kind") == "delete", ["event_id", "event_type", "value"])


LINE = "l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, l_partkey, l_suppkey"


@query(f"""SELECT l_orderkey, l_linenumber, {LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS n FROM lineitem) WHERE n = 1""")
def compact_lineitem(spark, sf_dir):
    """Repeated keys without positions: the order is all columns."""
    cols = LINE.split(", ")
    df = table(spark, sf_dir, "lineitem")
    return compact.latest(df, ["l_orderkey", "l_linenumber"], F.struct(*cols), F.lit(False), cols)


def _split(spark, sf_dir) -> DataFrame:
    out = log.split_key_changes(mutable_key_log(spark, sf_dir), F.col("old_key"))
    return out.select("lsn", "seq", "kind", F.col("key.user_id").alias("user_id"), F.col("key.event_type").alias("event_type"), F.col("new.event_id").alias("event_id"))


@query(f"WITH {L2}, {SPLIT} SELECT lsn, seq, kind, user_id, event_type, coalesce(event_id, -1) AS event_id FROM split")
def split_key_change(spark, sf_dir):
    """-1 stands for the missing new row of a delete."""
    return _split(spark, sf_dir).fillna(-1, ["event_id"])


@query(f"""WITH {L2}, {SPLIT} SELECT user_id, event_type, arg_max(event_id, lsn * 2 + seq) AS event_id FROM split
  GROUP BY 1, 2 HAVING arg_max(kind, lsn * 2 + seq) <> 'delete'""")
def compact_after_split(spark, sf_dir):
    """What is left after splitting: one live row a user, under its current key."""
    return compact.latest(_split(spark, sf_dir), ["user_id", "event_type"], log.position(), F.col("kind") == "delete", ["event_id"])


@query(f"""WITH {L1}, m AS (SELECT 'events' AS topic, user_id AS key, CASE WHEN kind = 'delete' THEN NULL ELSE props END AS value, lsn FROM l1)
  SELECT topic, key, arg_max(coalesce(value, chr(0)), lsn) AS value, max(lsn) AS lsn, 0 AS seq FROM m GROUP BY 1, 2
  HAVING arg_max(coalesce(value, chr(0)), lsn) <> chr(0)""")
def compact_topic(spark, sf_dir):
    """A topic of upserts and tombstones, with every message delivered twice, folded to its state."""
    once = messages.to_messages(event_log(spark, sf_dir), F.col("user_id"), F.col("props"), F.lit("events"))
    return compact.compact_messages(messages.deduplicate(once.unionAll(once)))


# ---------------------------------------------------------------- transactions

_TXN = f"""{L1}, txn AS (SELECT xid, count(*) AS events,
  count(*) FILTER (WHERE event_type = 'click' AND event_id % 97 = 0) AS pending, min(lsn) AS first_lsn, max(lsn) AS last_lsn, max(lsn) AS commit_lsn FROM l1 GROUP BY xid)"""


@query(f"WITH {_TXN} SELECT * FROM txn")
def txn_summary(spark, sf_dir):
    return transactions.summary(event_log(spark, sf_dir), acknowledged())


@query(f"""WITH {_TXN} SELECT max(commit_lsn) FILTER (WHERE commit_lsn < coalesce((SELECT min(commit_lsn) FROM txn WHERE pending > 0), 9223372036854775807)) AS checkpoint_lsn FROM txn""")
def checkpoint_prefix(spark, sf_dir):
    return transactions.checkpoint(transactions.summary(event_log(spark, sf_dir), acknowledged()))


@query(f"""WITH {_TXN}, b AS (SELECT coalesce(min(commit_lsn), 9223372036854775807) AS b FROM txn WHERE pending > 0)
  SELECT xid, commit_lsn, greatest(sum(CASE WHEN commit_lsn >= b THEN 1 ELSE 0 END) OVER (ORDER BY commit_lsn), 1)::BIGINT AS in_flight FROM txn, b""")
def in_flight(spark, sf_dir):
    flights = transactions.in_flight(transactions.summary(event_log(spark, sf_dir), acknowledged()))
    return flights.select("xid", "commit_lsn", "in_flight")


@query(f"""WITH {L1}, xs AS (SELECT DISTINCT xid FROM l1)
  SELECT xid, CASE WHEN xid % 50 = 0 THEN 'no commit' ELSE '2 begin events' END AS fault FROM xs WHERE xid % 50 = 0 OR xid % 50 = 7""")
def txn_brackets(spark, sf_dir):
    """Begin and commit events around each transaction, some of them damaged, validated."""
    rows = event_log(spark, sf_dir).select("xid", "lsn", "seq", "kind")
    xids = rows.groupBy("xid").agg(F.min("lsn").alias("a"), F.max("lsn").alias("z"))
    begin = xids.select("xid", F.col("a").alias("lsn"), F.lit(-1).alias("seq"), F.lit("begin").alias("kind"))
    twice = begin.filter("xid % 50 = 7").withColumn("seq", F.lit(-2))
    commit = xids.filter("xid % 50 <> 0").select("xid", F.col("z").alias("lsn"), F.lit(9).alias("seq"), F.lit("commit").alias("kind"))
    return transactions.brackets(rows.unionByName(begin).unionByName(twice).unionByName(commit))


# ---------------------------------------------------------------- schemas in force

_SCHEMAS = f"schemas(relid, lsn, seq, schema_version) AS (VALUES {values(SCHEMA_EVENTS)})"


@query(f"""WITH {L1}, {_SCHEMAS} SELECT lsn, seq, (SELECT s.schema_version FROM schemas s WHERE s.relid = {EVENTS_RELID} AND (s.lsn < l1.lsn OR (s.lsn = l1.lsn AND s.seq <= l1.seq))
  ORDER BY s.lsn DESC, s.seq DESC LIMIT 1) AS schema_version FROM l1""")
def schema_as_of(spark, sf_dir):
    rows = event_log(spark, sf_dir).select("lsn", "seq", "relid")
    return log.schema_in_force(rows, schema_events(spark)).select("lsn", "seq", "schema_version")


@query(f"""WITH {_SCHEMAS} SELECT relid::BIGINT AS relid, lsn::BIGINT AS lsn, schema_version, CASE WHEN p IS NULL THEN 'new' WHEN p = schema_version THEN 'unchanged' ELSE 'changed' END AS change
  FROM (SELECT *, lag(schema_version) OVER (PARTITION BY relid ORDER BY lsn, seq) AS p FROM schemas)""")
def schema_changed(spark, sf_dir):
    return log.schema_changes(schema_events(spark)).select("relid", "lsn", "schema_version", "change")


# ---------------------------------------------------------------- names and positions

_FIXED_NAMES = values((
    ("users", "users"), ("crêpes", "cr_c3__aa_pes"), ("9lives", "_39_lives"), ("a.b", "a_2e_b"), ("person/name", "person_2f_name"),
    ("flobble-biscuits?whatisthetime/hahahaha", "flobble_2d_biscuits_3f_whatisthetime_2f_hahahaha"), ("z" * 63, "z" * 63), ("_ok", "_ok"),
    ("Straße 1", "Stra_c3__9f_e_20_1"), ("日本", "_e6__97__a5__e6__9c__ac_"),
))


@query(f"SELECT * FROM (VALUES {_FIXED_NAMES}) t(name, safe)")
def sanitise_names(spark, sf_dir):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    return names.select("name", naming.sanitise_column(F.col("name")).alias("safe"))


@query("""SELECT c_custkey, 'Customer_23_' || replace(c_name, 'Customer#', '') AS safe FROM customer WHERE c_name LIKE 'Customer#%'
  UNION ALL SELECT c_custkey, regexp_replace(c_name, '[^A-Za-z0-9_]', '', 'g') FROM customer WHERE c_name NOT LIKE 'Customer#%'""")
def sanitise_customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", naming.sanitise_column(F.col("c_name")).alias("safe"))


@query("""SELECT r_name, n_name, 'tide.' || replace(r_name, ' ', '_20_') || '.' || replace(n_name, ' ', '_20_') AS topic,
  'tide.' || replace(n_name, ' ', '_20_') || '-key' AS subject FROM nation JOIN region ON n_regionkey = r_regionkey""")
def topic_names(spark, sf_dir):
    joined = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    topic = naming.checked_topic(naming.topic_column(F.col("n_name"), F.col("r_name"), "tide"))
    plain = naming.topic_column(F.col("n_name"), F.lit("public"), "tide")
    return joined.select("r_name", "n_name", topic.alias("topic"), naming.subject_column(plain, "key").alias("subject"))


@query(f"SELECT * FROM (VALUES {values((t, n, t) for t, n in LSNS)}) t(text, lsn, again)")
def lsn_roundtrip(spark, sf_dir):
    d = spark.createDataFrame([(t,) for t, _ in LSNS], "text string").withColumn("lsn", naming.parse_lsn_column(F.col("text")))
    return d.withColumn("again", naming.format_lsn_column(F.col("lsn")))


@query("SELECT event_id, printf('%X/%X', (event_id * 7919) >> 8, (event_id * 7919 * 104729) & 4294967295) AS text FROM events")
def lsn_text(spark, sf_dir):
    high = F.shiftright(F.col("event_id") * 7919, 8)
    low = (F.col("event_id") * 7919 * 104729).bitwiseAND(F.lit(0xFFFFFFFF))
    return table(spark, sf_dir, "events").select("event_id", naming.format_lsn_column(F.shiftleft(high, 32).bitwiseOR(low)).alias("text"))


@query("SELECT event_id, epoch_us(ts) - 946684800000000 AS micros FROM events")
def source_clock(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", naming.source_clock(F.col("ts")).alias("micros"))


# ---------------------------------------------------------------- time parts

_PARTS = "year({c})::INT AS year, month({c})::INT AS month, day({c})::INT AS day, hour({c})::INT AS hour, minute({c})::INT AS minute, second({c})::INT AS second, (epoch_us({c}) % 1000000)::INT AS micro"


@query(f"SELECT 'o' || o_orderkey AS id, {_PARTS.format(c='o_orderdate')} FROM orders UNION ALL SELECT 'e' || event_id, {_PARTS.format(c='ts')} FROM events")
def datetime_parts(spark, sf_dir):
    def parts(name, key, ts, letter):
        d = table(spark, sf_dir, name).select(F.concat(F.lit(letter), F.col(key)).alias("id"), temporal.timestamp_parts(F.col(ts)).alias("p"))
        return d.select("id", "p.*")

    return parts("orders", "o_orderkey", "o_orderdate", "o").unionAll(parts("events", "event_id", "ts", "e"))


@query("""SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day,
  0 AS zone_offset, 19800 AS east, -25200 AS west, (epoch_us(o_orderdate) % 86400000000)::BIGINT AS time_micros FROM orders""")
def date_and_time(spark, sf_dir):
    ts = F.col("o_orderdate")
    parts = temporal.date_parts(F.to_date(ts))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parts["year"].alias("year"), parts["month"].alias("month"), parts["day"].alias("day"),
        *[temporal.zone_offset(ts.cast("timestamp"), zone).cast("int").alias(name)
          for name, zone in (("zone_offset", "UTC"), ("east", "Asia/Kolkata"), ("west", "America/Phoenix"))],
        temporal.time_micros(ts).alias("time_micros"),
    )


@query("""WITH d AS (SELECT event_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS u, event_id % 30 - 14 AS m FROM events)
  SELECT event_id, (sign(m) * (abs(m) // 12))::INT AS year, (sign(m) * (abs(m) % 12))::INT AS month, 3 AS day, (sign(u) * (abs(u) // 3600000000))::INT AS hour,
  (sign(u) * (abs(u) // 60000000 % 60))::INT AS minute, (sign(u) * (abs(u) // 1000000 % 60))::INT AS second, (sign(u) * (abs(u) % 1000000))::INT AS micro FROM d""")
def interval_parts(spark, sf_dir):
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit("2024-01-01").cast("timestamp"))
    parts = temporal.interval_parts(F.col("event_id") % 30 - 14, F.lit(3), micros)
    return table(spark, sf_dir, "events").select("event_id", parts.alias("p")).select("event_id", "p.*")


@query("SELECT v AS text, s AS special FROM (VALUES ('infinity', 'POS_INFINITY'), ('-infinity', 'NEG_INFINITY'), ('2014-12-27', NULL)) t(v, s)")
def special_times(spark, sf_dir):
    d = spark.createDataFrame([("infinity",), ("-infinity",), ("2014-12-27",)], "text string")
    return d.select("text", temporal.special_of(F.col("text")).alias("special"))


@query("SELECT c_custkey, round(c_acctbal * 100)::BIGINT AS cents FROM customer")
def money_minor_units(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal").cast("decimal(18,2)") * 100).cast("long").alias("cents"))


@query("SELECT p_partkey, p_retailprice::DECIMAL(18, 2)::DOUBLE AS price FROM part")
def numeric_as_double(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(18,2)").cast("double").alias("price"))


# ---------------------------------------------------------------- encodings


@query("""SELECT '{"n_nationkey":{"int":' || n_nationkey || '}}' AS key,
  '{"n_nationkey":{"int":' || n_nationkey || '},"n_name":{"string":' || to_json(n_name) || '},"n_regionkey":{"int":' || n_regionkey || '}}' AS value FROM nation""")
def json_messages_nation(spark, sf_dir):
    return encoded_snapshot(table(spark, sf_dir, "nation"), BY_NAME["nation"]).select("key", "value")


@query("""SELECT '{"conv_id":{"long":' || conv_id || '},"turn":{"long":' || turn || '}}' AS key,
  '{"conv_id":{"long":' || conv_id || '},"turn":{"long":' || turn || '},"role":' || coalesce('{"string":' || to_json(role) || '}', 'null') ||
  ',"text":' || coalesce('{"string":' || to_json(text) || '}', 'null') || '}' AS value FROM conversations""")
def json_messages_conversations(spark, sf_dir):
    return encoded_snapshot(table(spark, sf_dir, "conversations"), BY_NAME["conversations"]).select("key", "value")


def _json_orders_sql() -> str:
    parts = ",".join(f'"{p}":\' || {p}(o_orderdate) || \'' for p in ("year", "month", "day", "hour", "minute", "second"))
    micro = "',\"micro\":' || (epoch_us(o_orderdate) % 1000000)::BIGINT || '"
    plain = lambda c, kind: f'"{c}":{{{{"{kind}":\' || {c} || \'}}}}'.replace("{{", "{").replace("}}", "}")
    text = lambda c: f'"{c}":{{{{"string":\' || to_json({c}) || \'}}}}'.replace("{{", "{").replace("}}", "}")
    date = f'"o_orderdate":{{"tideline.datatypes.DateTime":{{{parts}\' || {micro}}}}}'
    fields = [plain("o_orderkey", "long"), plain("o_custkey", "long"), text("o_orderstatus"), plain("o_totalprice", "double"), date, text("o_orderpriority")]
    return f"SELECT o_orderkey, '{{{','.join(fields)}}}' AS value FROM orders"


@query(_json_orders_sql())
def json_messages_orders(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return df.select("o_orderkey", json_column(df.schema, df.columns).alias("value"))


@query("""SELECT '02' || printf('%02X', n_nationkey * 2) AS key, '02' || printf('%02X', n_nationkey * 2) || '02' || printf('%02X', strlen(n_name) * 2) || hex(n_name) ||
  '02' || printf('%02X', n_regionkey * 2) AS value FROM nation""")
def avro_nation_hex(spark, sf_dir):
    """Small numbers: each zig-zag varint is one byte."""
    return encoded_snapshot(table(spark, sf_dir, "nation"), BY_NAME["nation"], "avro").select(F.hex("key").alias("key"), F.hex("value").alias("value"))


_VARINT = """CASE WHEN z < 128 THEN printf('%02X', z) WHEN z < 16384 THEN printf('%02X%02X', z & 127 | 128, z >> 7)
  WHEN z < 2097152 THEN printf('%02X%02X%02X', z & 127 | 128, z >> 7 & 127 | 128, z >> 14)
  ELSE printf('%02X%02X%02X%02X', z & 127 | 128, z >> 7 & 127 | 128, z >> 14 & 127 | 128, z >> 21) END"""


@query(f"""SELECT doc_id, '02' || {_VARINT} || coalesce('02' || printf('%02X', quality * 2), '00') || coalesce('02' || printf('%02X', toxic * 2), '00') AS value
  FROM (SELECT doc_id, quality, toxic, doc_id * 2 AS z FROM labels)""")
def avro_labels_hex(spark, sf_dir):
    df = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return avro.encode_table(df, "labels", keep=["doc_id"]).select("doc_id", F.hex("value").alias("value"))


@query("SELECT count(*) AS n_rows, count(*) AS same_rows FROM lineitem")
def avro_lineitem_roundtrip(spark, sf_dir):
    """Doubles, text and timestamps through the Arrow encoder and back."""
    df = table(spark, sf_dir, "lineitem")
    schema = avro.row_schema("lineitem", df.schema)
    again = avro.decode_rows(avro.encode_table(df, "lineitem"), schema, df.schema)
    both = df.groupBy(df.columns).agg(F.count("*").alias("a")).join(
        again.groupBy(df.columns).agg(F.count("*").alias("b")), df.columns, "inner"
    )
    return both.agg(F.sum("a").alias("n_rows"), F.sum(F.least("a", "b")).alias("same_rows"))


@query("SELECT n_nationkey, '000000002A' || hex(n_name) AS framed, NULL::VARCHAR AS tombstone FROM nation")
def schema_prefix(spark, sf_dir):
    none = avro.schema_prefix(42, F.lit(None).cast("binary"))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", F.hex(avro.schema_prefix(42, F.col("n_name").cast("binary"))).alias("framed"), F.hex(none).alias("tombstone")
    )


@query(f"""WITH {L1} SELECT event_id AS frame, 0 AS seq, kind, {EVENTS_RELID}::BIGINT AS relid, hex(user_id::VARCHAR) AS key FROM l1""")
def frame_messages(spark, sf_dir):
    """Every event packed into a binary frame and exploded into messages again."""
    rows = event_log(spark, sf_dir).select("event_id", "kind", F.col("user_id").cast("string").cast("binary").alias("k"))
    none = F.lit(b"\x00")
    relid = avro.varint_column(F.lit(EVENTS_RELID))
    key = F.concat(F.lit(b"\x02"), avro.varint_column(F.octet_length("k")), F.col("k"))
    empty_row = F.lit(b"\x00")
    body = (
        F.when(F.col("kind") == "insert", F.concat(avro.varint_column(F.lit(3)), relid, key, empty_row))
        .when(F.col("kind") == "update", F.concat(avro.varint_column(F.lit(4)), relid, key, none, empty_row))
        .otherwise(F.concat(avro.varint_column(F.lit(5)), relid, key, none))
    )
    frames = rows.select(F.col("event_id").alias("lsn"), F.concat(avro.varint_column(F.lit(1)), body, F.lit(b"\x00")).alias("frame"))
    out = log.explode_frames(frames)
    return out.select(F.col("frame_lsn").alias("frame"), "seq", "kind", "relid", F.hex("key").alias("key"))


# ---------------------------------------------------------------- partitions and policy


@query("SELECT user_id AS key, 1::BIGINT AS partitions FROM events GROUP BY user_id")
def partition_stable(spark, sf_dir):
    """All messages of a key, whatever happened to it, go to one partition."""
    sent = messages.to_messages(event_log(spark, sf_dir), F.col("user_id").cast("string"), F.col("props"), F.lit("events"), 8)
    return sent.groupBy(F.col("key").cast("long").alias("key")).agg(F.countDistinct("partition").alias("partitions"))


@query()
def partition_numbers(spark, sf_dir):
    sent = messages.to_messages(event_log(spark, sf_dir), F.col("user_id").cast("string"), F.col("props"), F.lit("events"), 8)
    return sent.groupBy("partition").agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))


@query("SELECT doc_id, strlen(text) AS n_bytes FROM documents WHERE strlen(text) <= 4096")
def oversize_skipped(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    fine, _ = apply_policy(rows, row_fault(F.col("text"), 4096), ErrorPolicy.LOG)
    return fine.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))


@query("SELECT doc_id, 'row of ' || strlen(text) || ' bytes, at most 4096 are allowed' AS error FROM documents WHERE strlen(text) > 4096")
def oversize_set_aside(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_policy(rows, row_fault(F.col("text"), 4096), ErrorPolicy.LOG)[1].select("doc_id", "error")


@query(f"WITH {L1} SELECT lsn, user_id FROM l1 WHERE user_id % 5 = 0")
def unknown_relations(spark, sf_dir):
    """Events whose table nobody has announced."""
    logged = event_log(spark, sf_dir).withColumn("relid", F.col("user_id") % 5)
    known = spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "relid long")
    return dead_letters(logged, known).select("lsn", "user_id")


# ---------------------------------------------------------------- streaming


def work_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = tempfile.mkdtemp(prefix="tideline-")
    return f"{base}/tideline/work-{uuid.uuid4().hex}"


def is_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory())


@query(_COMPACT)
def stream_compact_latest(spark, sf_dir):
    """The events table as a stream, compacted with state, must equal the batch result."""
    work = work_folder(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # A stream source is a folder; the table may be one file in it.
    source = spark.readStream.schema(schema)
    if is_folder(spark, f"{sf_dir}/events.parquet"):
        source = source.parquet(f"{sf_dir}/events.parquet")
    else:
        source = source.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    keep = ["event_id", "event_type", "value"]
    state = compaction.latest_stream(log_of_events(source), ["user_id"], log.position(), F.col("kind") == "delete", keep)
    query = compaction.write_changes(state, f"{work}/changes", f"{work}/checkpoint")
    query.awaitTermination()
    changes = spark.read.schema(state.schema).parquet(f"{work}/changes/*")
    return compaction.current_state(changes, ["user_id"], keep)


def _followed(spark: SparkSession, log: DataFrame, transactions_a_batch: int) -> DataFrame:
    """A log written to files and read as a stream of whole transactions."""
    path = f"{work_folder(spark)}/log"
    changelog.write_log(log, path)
    changelog.register(spark)
    reader = spark.readStream.format("changelog").schema(log.schema).option("path", path)
    return reader.option("maxTransactions", transactions_a_batch).load()


@query(ORACLES["compact_after_split"])
def stream_split_messages(spark, sf_dir):
    """A table whose keys change, followed as a stream: split, encoded, published to a folder, stopped and resumed, folded."""
    work = work_folder(spark)
    rows = _followed(spark, mutable_key_log(spark, sf_dir), 600)
    sink = FolderSink(f"{work}/topics")
    job = Job(sink, f"{work}/checkpoint", form="json")
    stored = Table(EVENTS_RELID, "events", ["user_id", "event_type"])
    job.stream_table(rows, stored).awaitTermination()  # one batch, then stopped
    follow(lambda trigger: job.stream_table(rows, stored, trigger=trigger))
    # All of it again, from another start and in other batches: seen once.
    again = Job(sink, f"{work}/again", form="json")
    again.stream_table(_followed(spark, mutable_key_log(spark, sf_dir), 1_000_000), stored).awaitTermination()
    live = compact.compact_messages(sink.read(spark))
    part = lambda c, path, to: F.get_json_object(c, path).cast(to)
    return live.select(
        part("key", "$.user_id.long", "long").alias("user_id"), part("key", "$.event_type.string", "string").alias("event_type"),
        part("value", "$.event_id.long", "long").alias("event_id"),
    )


CHANGE_AT = 501


@query(f"""SELECT CASE WHEN event_id < {CHANGE_AT} THEN 'tide.events' ELSE 'tide.happenings' END AS topic,
  '{{"event_id":{{"long":' || event_id || '}}}}' AS key, '{{"event_id":{{"long":' || event_id || '}},"user_id":{{"long":' || user_id || '}}' ||
  CASE WHEN event_id < {CHANGE_AT} THEN '' ELSE ',"event_type":{{"string":"' || event_type || '"}}' END || '}}' AS value FROM events WHERE event_id % 10 <> 9
  UNION ALL SELECT CASE WHEN event_id < {CHANGE_AT} THEN 'tide.events' ELSE 'tide.happenings' END, '{{"event_id":{{"long":' || event_id || '}}}}', NULL FROM events WHERE event_id % 10 = 9""")
def schema_change_stream(spark, sf_dir):
    """Encoded events of a table that is renamed and gets a column in mid-stream; rows go by the schema in force."""
    work = work_folder(spark)
    sink = FolderSink(f"{work}/topics")
    job = Job(sink, f"{work}/checkpoint", form="json", topic_prefix="tide")
    events = _followed(spark, encoded_events(spark, sf_dir, CHANGE_AT), 600)
    follow(lambda trigger: job.stream_events(events, trigger=trigger))
    return sink.read(spark).select("topic", "key", "value")
