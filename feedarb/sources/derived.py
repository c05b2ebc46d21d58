"""Feeds derived from the given tables.

The given ``events`` table has one row per event.  These expressions turn it
into what a fleet of publishers would have delivered: seven machines of which
up to five run at a time, lost copies, redeliveries, retirements, damaged
messages and an audit log.  The SQL text is shared with the DuckDB checks, where
only the reading of times, bytes and arrays is written differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedarb.plans.storage import bounded_tasks, enough_partitions
from feedarb.sources.landing import landed_paths, read_landed

# Fixed values of the derived fleet, in microseconds since the epoch.
FEED_START_US = 1_704_067_200_000_000
SERVICE_US = 777_600_000_000
REDELIVERY_US = 40_000_000_000

STREAM_OF_EVENT = (
    "case when event_type in ('click','signup') then 'trade'"
    " when event_type in ('view','error') then 'depth' else 'aggtrade' end"
)
PREFIX_OF_EVENT = (
    "case when event_type in ('click','signup') then 't'"
    " when event_type in ('view','error') then 'd' else 'aT' end"
)
SYMBOL_OF_EVENT = "concat('sym', cast(user_id % 3 as string))"

# Which of the seven machines delivered which event, and when.
COPY_DELIVERED = f"""(event_id * 31 + s * 17) % 13 <> 0 and (s in (2, 3, 4)
  or (s in (0, 1) and ts_us < {FEED_START_US} + (s + 1) * {SERVICE_US})
  or (s in (5, 6) and ts_us >= {FEED_START_US} + (s - 4) * {SERVICE_US}))"""
COPY_ARRIVAL = (
    "ts_us + (s * 300 + (event_id * 7919 + s * 104729) % 14400) * 1000000"
    f" + redelivery * {REDELIVERY_US}"
)
COPY_REDELIVERED = "redelivery = 0 or (event_id + s) % 29 = 0"
SOURCE_NAME = "concat('ip-172-31-', cast(s as string), '-10.ap-northeast-1.compute.internal')"
MESSAGE_KEY = "concat(key_prefix, ':', cast(event_id as string))"
ARRIVAL_ORDER = ("arr_us", "event_id", "s", "redelivery")

_landed: dict[tuple, tuple[str, str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_tasks(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_state(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Path, length and time of change of a table's files: another state, another table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = system.listStatus(path)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their stream, symbol and time in microseconds (UTC)."""
    events = table(spark, sf_dir, "events")
    # Wall-clock times count as UTC whatever the session's time zone is.
    ts_us = F.expr(
        "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))"
    )
    return events.select(
        "event_id",
        ts_us.alias("ts_us"),
        F.expr(STREAM_OF_EVENT).alias("stream_type"),
        F.expr(PREFIX_OF_EVENT).alias("key_prefix"),
        F.expr(SYMBOL_OF_EVENT).alias("symbol"),
        "user_id",
        "value",
    )


def delivered_copies(spark: SparkSession, sf_dir: str, redelivery: bool) -> DataFrame:
    """One row per delivered copy, with arrival times but without offsets, keys and names of machines."""
    passes = F.array(F.lit(0), F.lit(1)) if redelivery else F.array(F.lit(0))
    return (
        feed_events(spark, sf_dir)
        .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(6))))
        .where(COPY_DELIVERED)
        .withColumn("redelivery", F.explode(passes))
        .where(COPY_REDELIVERED)
        .select(
            "stream_type",
            "symbol",
            "event_id",
            "key_prefix",
            F.expr(COPY_ARRIVAL).alias("arr_us"),
            "value",
            "s",
            "redelivery",
        )
    )


def copies(spark: SparkSession, sf_dir: str, redelivery: bool = True) -> DataFrame:
    """The landed feed: normalised copies with broker-style offsets.

    Landed once per application and state of the input, as a feed is, and read from then on.
    """
    bounded_tasks(spark)
    state = input_state(spark, sf_dir, "events")
    enough_partitions(spark, sum(length for _, length, _ in state))
    key = (spark.sparkContext.applicationId, state, redelivery)
    if key not in _landed:
        _landed[key] = landed_paths(delivered_copies(spark, sf_dir, redelivery), ARRIVAL_ORDER)
    return read_landed(spark, _landed[key]).select(
        "stream_type",
        "symbol",
        "event_id",
        F.expr(MESSAGE_KEY).alias("msg_key"),
        F.expr(SOURCE_NAME).alias("source_id"),
        "arr_us",
        "value",
        "seq_offset",
    )


# --- broker messages with damaged headers and keys --------------------------------------

RAW_KEY = "case when event_id % 47 = 0 then null else msg_key end"
RAW_NO_SOURCE = "event_id % 41 = 0"
RAW_SYMBOL = "case when event_id % 43 = 0 then '' else symbol end"
RAW_TWICE = "event_id % 53 = 0"


def raw_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed feed as broker messages; some lack a header or the key."""

    def header(name: str, text: str) -> str:
        return f"named_struct('key', '{name}', 'value', cast({text} as binary))"

    return copies(spark, sf_dir).select(
        F.expr(f"cast({RAW_KEY} as binary)").alias("key"),
        F.expr("cast(concat('{\"id\":', cast(event_id as string), '}') as binary)").alias("value"),
        F.expr(
            f"""filter(array(
              case when {RAW_NO_SOURCE} then null else {header('source_id', 'source_id')} end,
              {header('stream_type', 'stream_type')},
              {header('symbol', RAW_SYMBOL)},
              case when {RAW_TWICE} then {header('symbol', "'second'")} end
            ), h -> h is not null)"""
        ).alias("headers"),
        F.lit("market-data-raw").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq_offset").alias("offset"),
        F.timestamp_micros("arr_us").alias("timestamp"),
    )


# --- captured lines and keys ------------------------------------------------------------

CAPTURED_STREAM = (
    "case when event_id % 23 = 0 then 'liquidation' when event_type in ('click','signup')"
    " then 'Trade' when event_type in ('view','error') then 'depth' else 'aggTrade' end"
)
CAPTURED_ID_FIELD = (
    "case when event_type in ('click','signup') then 't'"
    " when event_type in ('view','error') then 'u' else 'a' end"
)
CAPTURED_LINE = f"""case
  when event_id % 17 = 1 then concat('{{"{{f}}":', cast(event_id as string))
  when event_id % 17 = 2 then concat('{{"other":', cast(event_id as string), '}}')
  when event_id % 17 = 3 then '{{"{{f}}":null}}'
  when event_id % 17 = 4 then concat('[', cast(event_id as string), ']')
  when event_id % 17 = 5 then concat('{{"{{f}}":', cast(event_id as string), '}} tail')
  when event_id % 17 = 6 then concat('{{"E":1,"{{f}}":"', cast(event_id as string), '","p":{{"{{f}}":0}}}}')
  else concat('{{"{{f}}":', cast(event_id as string), ',"k":', props, '}}') end"""
KEY_TEXT = """case
  when event_id % 11 = 1 then concat('t:', cast(event_id as string), ':', cast(user_id as string))
  when event_id % 11 = 2 then concat(':', cast(event_id as string))
  when event_id % 11 = 3 then 'aT:'
  when event_id % 11 = 4 then concat('key', cast(event_id as string))
  when event_id % 11 = 5 then concat('d::', cast(event_id as string))
  else concat('aT:', cast(event_id as string)) end"""


def captured_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as a publisher captures them, some of them damaged."""
    line = f"replace({CAPTURED_LINE}, '{{f}}', {CAPTURED_ID_FIELD})"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"{CAPTURED_STREAM} as stream_type",
        "concat('SYM', cast(user_id % 3 as string)) as symbol",
        "'capture' as source_id",
        f"{line} as line",
    )


def written_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{KEY_TEXT} as msg_key")


# --- machines ---------------------------------------------------------------------------


def node_name(k: str) -> str:
    """Name of machine ``k``: some not address-shaped, some with octets over 255."""
    return f"""case when {k} % 13 = 7 then concat('node-', cast({k} as string))
      else concat('ip-172-31-', cast({k} * 2 as string), '-010',
        case when {k} % 5 = 0 then '' else '.ap-northeast-1.compute.internal' end) end"""


NODE_PROVIDER = """case when s_suppkey % 3 = 0 then concat('aws:///ap-northeast-1a/i-0a', cast(s_suppkey as string))
  when s_suppkey % 6 = 2 then concat('gce://zone/', cast(s_suppkey as string))
  when s_suppkey % 6 = 5 then '' end"""
NODE_ROLE = "case when s_suppkey % 11 = 5 then null when s_suppkey % 11 = 6 then 'kafka' else 'listener' end"
INSTANCE_IP = "concat('172.31.', cast(s_suppkey * 2 as string), '.10')"
INSTANCE_STATE = """case when s_suppkey % 4 = 2 then 'stopped'
  when s_suppkey % 4 = 3 and copy = 1 then 'stopped' else 'running' end"""
INSTANCE_KEPT = "copy = 0 or s_suppkey % 4 in (1, 3)"
INSTANCE_ID = "concat('i-0b', cast(s_suppkey as string), cast(copy as string))"


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node inventory: one node per supplier."""
    return table(spark, sf_dir, "supplier").selectExpr(
        f"{node_name('s_suppkey')} as name",
        f"map_filter(map('role', {NODE_ROLE}), (k, v) -> v is not null) as labels",
        f"{NODE_PROVIDER} as provider_id",
        "s_suppkey % 7 = 0 as unschedulable",
    )


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machines: one running, two on one address, or none running."""
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
        .where(INSTANCE_KEPT)
        .selectExpr(
            f"{INSTANCE_ID} as instance_id",
            f"{INSTANCE_IP} as private_ip",
            f"{INSTANCE_STATE} as state",
        )
    )


# --- the audit log ----------------------------------------------------------------------

_SEC = "substr(cast(ts_us as string), 1, 10)"
_GROUP = "'\"stream_type\":\"', stream_type, '\",\"symbol\":\"', symbol, '\"'"
_NAMED = f"concat('\"', {node_name('user_id')}, '\"')"
_COUNTS = "concat('{\"a\":', cast(event_id % 50 as string), ',\"b\":', cast(event_id % 70 as string), '}')"


def _verdict(version: str, named: str, reason: str) -> str:
    return f"""concat('{{"type":"verdict",{version}', {_GROUP}, ',"window_start":', {_SEC},
      '.25,"window_end":', {_SEC}, '.5,', {named}, '"counts":', {_COUNTS}, ',"total_events":',
      cast(event_id % 50 + event_id % 70 as string), ',"sources_seen":2,"reason":', {reason}, '}}')"""


_TALLY_BODY = f"""{_GROUP}, ',"window_start":', {_SEC}, '.25,"emitted_at":', {_SEC},
      '.75,"total_events":', cast(event_id % 50 as string)"""
_NAME = f"concat('\"slowest_source_id\":', {_NAMED}, ',')"
_KILL = f"""'{{"type":"kill_confirmed","schema_version":1,', {_GROUP}, ',"source_id":', {_NAMED},
      ',"terminated_at":', cast(cast(substr(cast(ts_us as string), 1, 10) as bigint) + event_id % 240 as string), '.125'"""

AUDIT_TEXT = f"""case event_id % 20
  when 0 then concat('{{"type":"tally","schema_version":1,', {_TALLY_BODY}, ',"counts":', {_COUNTS}, ',"correlation_id":null}}')
  when 1 then concat('{{"type":"tally",', {_TALLY_BODY}, ',"counts":', {_COUNTS}, ',"extra":[1]}}')
  when 2 then concat('{{"type":"tally","schema_version":1,', {_TALLY_BODY}, ',"counts":null}}')
  when 8 then {_verdict('', _NAME, "'null'")}
  when 9 then {_verdict('"schema_version":1,', "'\"slowest_source_id\":null,'", "'\"tie between 2 sources on 7 wins\"'")}
  when 10 then {_verdict('"schema_version":0,', "'\"slowest_source_id\":null,'", "'null'")}
  when 11 then {_verdict('"schema_version":1,', "''", "'null'")}
  when 12 then concat({_KILL}, ',"instance_id":"i-1","correlation_id":"c"}}')
  when 13 then concat({_KILL}, ',"instance_id":null}}')
  when 14 then concat({_KILL}, '}}')
  when 15 then concat('{{"type":"gate_stalled","schema_version":1,', {_GROUP}, ',"sources_confirmed":4,"sources_expected":5,"stalled_for_seconds":600.5,"ignored_sources":["x","y"],"emitted_at":', {_SEC}, '.5}}')
  when 16 then {_verdict('"schema_version":2,', _NAME, "'null'")}
  when 17 then case event_id % 3
    when 0 then {_verdict('"schema_version":"1",', _NAME, "'null'")}
    when 1 then concat('{{"type":"heartbeat",', {_GROUP}, '}}')
    else concat('{{"type":null,', {_GROUP}, '}}') end
  when 18 then case event_id % 3
    when 0 then concat('{{', {_GROUP}, '}}')
    when 1 then concat('[', {_SEC}, ']')
    else '{{"type":"verdict",' end
  when 19 then case event_id % 3
    when 0 then '{{"type":"tally"}} {{"type":"tally"}}'
    when 1 then concat('{{"type":["verdict"],', {_GROUP}, '}}')
    else 'broken' end
  else {_verdict('"schema_version":1,', _NAME, "'null'")} end"""
AUDIT_PARTITION = "case stream_type when 'trade' then 0 when 'depth' then 1 else 2 end"
# Not UTF-8: an opening brace and a stray byte.
BROKEN_BYTES = "unhex('7BFF7D')"
AUDIT_BYTES = f"case when body = 'broken' then {BROKEN_BYTES} else cast(body as binary) end"
# Which of the messages above are verdicts that name a source.
NAMING_VERDICT = "event_id % 20 between 3 and 8"

_logs: dict[tuple, tuple[str, str]] = {}


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log message per event, good and bad, in order of time per partition."""
    bounded_tasks(spark)
    state = input_state(spark, sf_dir, "events")
    enough_partitions(spark, sum(length for _, length, _ in state))
    key = (spark.sparkContext.applicationId, state)
    if key not in _logs:
        messages = (
            feed_events(spark, sf_dir)
            .withColumn("body", F.expr(AUDIT_TEXT))
            .select(
                F.expr(AUDIT_PARTITION).alias("partition"),
                F.expr(AUDIT_BYTES).alias("value"),
                F.expr(NAMING_VERDICT).alias("names_source"),
                "ts_us",
                "event_id",
            )
        )
        _logs[key] = landed_paths(messages, ("ts_us", "event_id"), ("partition",))
    return read_landed(spark, _logs[key], "offset", ("partition",))


# What came of an attempt: most end well, the others stop at a stage.
OUTCOME_OK = "event_id % 7 < 4"
OUTCOME_STAGE = "case event_id % 7 when 4 then 'cordon' when 5 then 'drain' when 6 then 'terminate' else 'done' end"
OUTCOME_INSTANCE = f"case when {OUTCOME_OK} then concat('i-0c', cast(event_id as string)) end"


def removal_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What acting on each naming verdict led to, had it been tried."""
    log = audit_log(spark, sf_dir).where("names_source").select("event_id", "offset")
    return (
        feed_events(spark, sf_dir)
        .join(log, "event_id")
        .selectExpr(
            "stream_type",
            "symbol",
            f"{node_name('user_id')} as source_id",
            "offset as verdict_offset",
            f"{OUTCOME_STAGE} as stage",
            f"{OUTCOME_OK} as ok",
            f"{OUTCOME_INSTANCE} as instance_id",
            f"case when {OUTCOME_OK} then ts_us + (event_id % 200) * 1000000 end as terminated_us",
        )
    )


# --- recorded windows and removals ------------------------------------------------------------------


NAMED_SOURCE = SOURCE_NAME.replace("cast(s ", "cast(naming % 2 ")
NAMED_AT = f"{FEED_START_US} + cast(naming + 1 as bigint) * {SERVICE_US} - case when naming = 2 then 86400000000 else 0 end"
# A log whose totals are one too high now and then.
RECORDED_TOTAL = "total_events + case when window_no % 7 = 3 then 1 else 0 end"


def retirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded naming verdicts: machines 0 and 1 at the end of their service, 0 once more later."""
    groups = feed_events(spark, sf_dir).select("stream_type", "symbol").distinct()
    return groups.withColumn("naming", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).selectExpr(
        "stream_type",
        "symbol",
        f"{NAMED_SOURCE} as slowest_source_id",
        f"{NAMED_AT} as window_end_us",
    )


# Machines confirmed gone: 0 and 1 three hours after their service, 3 while it still delivers.
CONFIRMED_SOURCE = SOURCE_NAME.replace("cast(s ", "cast(case removal when 2 then 3 else removal end ")
CONFIRMED_AT = f"{FEED_START_US} + cast(removal + 1 as bigint) * {SERVICE_US} + 10800000000"
CONFIRMED_KEPT = "removal < 2 or symbol = 'sym1'"


def confirmed_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed removals of the derived fleet: (group, source_id, terminated_us)."""
    groups = feed_events(spark, sf_dir).select("stream_type", "symbol").distinct()
    return (
        groups.withColumn("removal", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .where(CONFIRMED_KEPT)
        .selectExpr("stream_type", "symbol", f"{CONFIRMED_SOURCE} as source_id", f"{CONFIRMED_AT} as terminated_us")
    )
