"""Dead letters."""

from checks.inputs import AS_OF, Inputs
from checks.registry import query
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tradewind.plans import dead_letters as d

BY_SERVICE = """
    SELECT s.service, COUNT(l.event_id) AS messages
    FROM (SELECT unnest(['cart', 'order', 'payment', 'inventory', 'notification']) AS service
          UNION SELECT service FROM dead_letters) s
    LEFT JOIN dead_letters l ON s.service = l.service
    GROUP BY s.service"""


@query("d1_dlq_by_service", BY_SERVICE)
def by_service(t: Inputs):
    return d.dlq_by_service(t.dead_letters)


@query(
    "d2_dlq_view",
    """
    SELECT event_id, original_topic, error_type, error_reason,
           substr(error_reason, 1, 80) AS reason_preview, retry_count, "partition", "offset"
    FROM dead_letters""",
)
def view(t: Inputs):
    return d.dlq_view(t.dead_letters)


@query(
    "d3_dlq_top_errors",
    f"""
    SELECT service, error_type, COUNT(*) AS errors FROM dead_letters
    WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOURS
    GROUP BY 1, 2 ORDER BY errors DESC, service, error_type LIMIT 10""",
)
def top_errors(t: Inputs):
    return d.dlq_top_errors(t.dead_letters, AS_OF, span="24 hours")


def raw_records(t: Inputs):
    """Events and conversations as they would arrive in one topic: only the former are records."""
    as_json = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type", F.col("props").alias("payload")))
    good = t.events.select(F.concat(F.lit("e"), "event_id").alias("record"), F.col("event_type").alias("topic"), as_json.alias("value"))
    lacking = t.table("labels").select(
        F.concat(F.lit("l"), "doc_id").alias("record"),
        F.lit("labels").alias("topic"),
        F.to_json(F.struct(F.col("doc_id").cast("string").alias("event_id"))).alias("value"),
    )
    text = t.table("conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("record"),
        F.lit("chat").alias("topic"),
        F.col("text").alias("value"),
    )
    return good.unionByName(lacking).unionByName(text)


RECORD = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("payload", T.StringType(), True),
    ]
)


RECORDS = """
    WITH judged AS (
      SELECT 'e' || event_id AS record, event_type AS topic, CAST(event_id AS VARCHAR) AS event_id, event_type,
             props AS payload, NULL AS value, NULL AS error_type, NULL AS error_reason
      FROM events
      UNION ALL SELECT 'l' || doc_id, 'labels', CAST(doc_id AS VARCHAR), NULL, NULL, '{"event_id":"' || doc_id || '"}',
                       'ValidationError', 'missing event_type'
      FROM labels
      UNION ALL SELECT 'c' || conv_id || '-' || turn, 'chat', NULL, NULL, NULL, text, 'JSONDecodeError',
                       'not a JSON object of this schema'
      FROM conversations)"""


@query(
    "d4_split_valid",
    f"""{RECORDS}
    SELECT *, CAST(NULL AS VARCHAR) AS correlation_id FROM judged""",
)
def split(t: Inputs):
    valid, rejected = d.split_valid(raw_records(t), RECORD)
    return valid.unionByName(rejected, allowMissingColumns=True)


@query(
    "d4_counts",
    """
    SELECT (SELECT COUNT(*) FROM events) AS valid,
           (SELECT COUNT(*) FROM labels) + (SELECT COUNT(*) FROM conversations) AS rejected""",
)
def counts(t: Inputs):
    """The counts that come with the split, without another pass."""
    seen = Observation()
    d.split_valid(raw_records(t), RECORD, seen)
    return t.spark.createDataFrame([(seen.get["valid"], seen.get["rejected"])], "valid long, rejected long")


@query(
    "d5_to_dlq",
    f"""{RECORDS}
    SELECT topic AS original_topic, event_type AS original_event_type, event_id, CAST(NULL AS VARCHAR) AS correlation_id,
           error_reason, error_type, 3 AS retry_count, value AS payload, 1706644800.0::DOUBLE AS timestamp
    FROM judged WHERE error_type IS NOT NULL""",
)
def build(t: Inputs):
    stamped = raw_records(t).withColumn("timestamp", F.lit("2024-01-30 20:00:00").cast("timestamp"))
    _, rejected = d.split_valid(stamped, RECORD)
    return d.to_dlq(rejected)


@query(
    "d6_replay",
    """
    SELECT original_topic AS topic, event_id AS key, payload AS value FROM dead_letters
    WHERE error_type <> 'ValueError'""",
)
def replay(t: Inputs):
    done = t.dead_letters.filter("error_type = 'ValueError'").select("event_id", "original_topic")
    return d.replay(t.dead_letters, done=done)


@query(
    "d7_replay_due",
    """
    SELECT COUNT(*) AS messages, 50 AS threshold,
           CASE WHEN COUNT(*) > 50 THEN 'REPLAY' ELSE 'NONE' END AS action,
           CASE WHEN COUNT(*) > 50 THEN 'DLQ count over threshold'
                ELSE 'DLQ count under threshold' END AS reason
    FROM dead_letters""",
)
def due(t: Inputs):
    return d.replay_due(t.dead_letters)


@query(
    "d7_replay_if_due",
    """
    SELECT original_topic AS topic, event_id AS key, payload AS value FROM dead_letters
    WHERE (SELECT COUNT(*) FROM dead_letters) > 50""",
)
def if_due(t: Inputs):
    return d.replay_if_due(t.dead_letters)


@query(
    "d8_dlq_band",
    f"""
    SELECT service, messages,
           CASE WHEN messages = 0 THEN 'HEALTHY' WHEN messages <= 5 THEN 'MINOR'
                WHEN messages <= 50 THEN 'MODERATE' ELSE 'CRITICAL' END AS band
    FROM ({BY_SERVICE}) c""",
)
def band(t: Inputs):
    return d.dlq_band(d.dlq_by_service(t.dead_letters))
