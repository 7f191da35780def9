"""Event-network views over the driver's tables, in two forms: DataFrames here, SQL text for oracles.

The tables hold no knowledge-graph data, so the views derive it deterministically: the event log from
``events``, memories and extractions from ``documents`` and ``labels``, lineage receipts and chat turns
from ``conversations``, ledger rows from ``lineitem``, ``part`` and ``supplier``, jobs from ``orders``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Sensor kinds in the order that a document's source number (modulo 8) picks them.
SENSORS = ("website", "discourse", "github-activity", "github", "gitlab", "notion", "podcast", "rss")
_SENSOR_SQL = "case " + " ".join(f"when n = {i} then '{s}'" for i, s in enumerate(SENSORS)) + " end"

VIEW_SQL = {
    "log": """select event_id as seq, ts, case event_type when 'signup' then 'NEW' when 'error' then 'FORGET' else 'UPDATE' end as event_type,
        'orn:user.state:' || user_id as rid, event_type || '-sensor-' || user_id as source_node, substr(sha256(props), 1, 16) as hash,
        user_id, cast(round(value * 100) as bigint) as size_bytes, event_type as kind from events""",
    "memories": f"""select doc_id, 'orn:web.page:' || source || '/' || doc_id as rid, {_SENSOR_SQL} || '-sensor:' || source as source_sensor, text, n_chars, lang,
        doc_id > first_id as superseded, doc_id % 7 = 0 as is_chunk, doc_id // 24 as day, doc_id % 24 as hour
        from (select *, cast(substr(source, 4) as integer) % 8 as n, min(doc_id) over (partition by text) as first_id from documents) d""",
    "extractions": """select m.doc_id, m.rid as memory_rid, m.rid || ':kg:extraction:v1' as extraction_rid, m.source_sensor, m.day, m.hour,
        case when l.quality = 1 then 'unified' else 'semantic' end as extraction_type, 'v' || (m.doc_id % 3) as extractor_version,
        50 + 40 * coalesce(l.quality, 0) - 20 * coalesce(l.toxic, 0) as confidence, m.n_chars as tokens, m.n_chars * 3 + 100 as cost,
        list_distinct(regexp_extract_all(m.text, '[A-Z][a-z]+')) as entities, list_sort(list_distinct(regexp_extract_all(m.text, '[a-z]+ing'))) as statements
        from memories m join labels l on l.doc_id = m.doc_id""",
    "receipts": """select conv_id, turn, 'm:' || conv_id || '/' || turn as output_rid, case when turn > 0 then 'm:' || conv_id || '/' || (turn - 1) end as input_rid,
        role as kind, length(text) as entities_extracted from conversations""",
    "batches": """select l_orderkey as batch, l_linenumber as line, p_brand as class_id, l_returnflag as flag, cast(round(l_quantity) as bigint) as amount,
        cast(round(l_extendedprice * 100) as bigint) as price, strftime(l_shipdate, '%Y-%m-%d') as issued, l_partkey as part
        from lineitem join part on p_partkey = l_partkey""",
    "validators": """select s_suppkey as address, cast(round(s_acctbal * 100) as bigint) as power, n_name as operator, s_name as moniker from supplier join nation on n_nationkey = s_nationkey""",
    "jobs": """select o_orderkey as id, o_custkey as worker, cast(substr(o_orderpriority, 1, 1) as integer) as priority,
        case when o_orderstatus = 'F' and o_orderkey % 5 = 0 then 'failed' when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' and o_orderkey % 3 = 0 then 'retrying' when o_orderstatus = 'O' then 'queued' else 'running' end as state,
        strftime(o_orderdate, '%Y-%m-%d') as scheduled_for, cast(round(o_totalprice) as bigint) % 10000 as seconds, o_orderkey % 4 as retry_count from orders""",
    "turns": "select conv_id, turn, role, text from conversations",
}


class Views:
    """The derived views of one data folder as DataFrames; nothing is read before it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def log(self) -> DataFrame:
        kind = F.when(F.col("event_type") == "signup", "NEW").when(F.col("event_type") == "error", "FORGET").otherwise("UPDATE")
        return self.table("events").select(
            F.col("event_id").alias("seq"), "ts", kind.alias("event_type"), F.concat(F.lit("orn:user.state:"), "user_id").alias("rid"),
            F.concat("event_type", F.lit("-sensor-"), "user_id").alias("source_node"), F.substring(F.sha2("props", 256), 1, 16).alias("hash"),
            "user_id", F.round(F.col("value") * 100).cast("long").alias("size_bytes"), F.col("event_type").alias("kind"),
        )

    @cached_property
    def memories(self) -> DataFrame:
        """Memories; a text's copies are found by its hash, so that texts themselves are not sort keys."""
        n = F.substring("source", 4, 10).cast("int") % 8
        sensor = F.element_at(F.array(*[F.lit(s) for s in SENSORS]), n + 1)
        first = F.min("doc_id").over(Window.partitionBy(F.sha2("text", 256)))
        return self.table("documents").select(
            "doc_id", F.concat(F.lit("orn:web.page:"), "source", F.lit("/"), "doc_id").alias("rid"), F.concat(sensor, F.lit("-sensor:"), "source").alias("source_sensor"), "text", "n_chars", "lang",
            (F.col("doc_id") > first).alias("superseded"), (F.col("doc_id") % 7 == 0).alias("is_chunk"), F.expr("doc_id div 24").alias("day"), (F.col("doc_id") % 24).alias("hour"),
        )

    @cached_property
    def extractions(self) -> DataFrame:
        labels = self.table("labels")
        m = self.memories
        entities = F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0)))
        statements = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit("[a-z]+ing"), F.lit(0))))
        return m.join(labels, "doc_id").select(
            "doc_id", F.col("rid").alias("memory_rid"), F.concat("rid", F.lit(":kg:extraction:v1")).alias("extraction_rid"), "source_sensor", "day", "hour",
            F.when(F.col("quality") == 1, "unified").otherwise("semantic").alias("extraction_type"), F.concat(F.lit("v"), F.col("doc_id") % 3).alias("extractor_version"),
            (50 + 40 * F.coalesce("quality", F.lit(0)) - 20 * F.coalesce("toxic", F.lit(0))).alias("confidence"), F.col("n_chars").alias("tokens"), (F.col("n_chars") * 3 + 100).alias("cost"),
            entities.alias("entities"), statements.alias("statements"),
        )

    @cached_property
    def labelled(self) -> DataFrame:
        """Every memory, with the figures of its extraction where it has one: documents are read once."""
        labels = self.table("labels").withColumn("labelled", F.lit(True))
        count = lambda pattern: F.size(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
        own = lambda value: F.when(F.col("labelled"), value)
        return self.memories.join(labels, "doc_id", "left").select(
            "doc_id", "source_sensor", "lang", "n_chars", own(F.concat("rid", F.lit(":kg:extraction:v1"))).alias("extraction_rid"), own(count("[A-Z][a-z]+")).alias("ne"), own(count("[a-z]+ing")).alias("ns"),
            own(50 + 40 * F.coalesce("quality", F.lit(0)) - 20 * F.coalesce("toxic", F.lit(0))).alias("confidence"), own(F.col("n_chars")).alias("tokens"), own(F.col("n_chars") * 3 + 100).alias("cost"),
        )

    @cached_property
    def receipts(self) -> DataFrame:
        name = lambda turn: F.concat(F.lit("m:"), "conv_id", F.lit("/"), turn)
        return self.table("conversations").select(
            "conv_id", "turn", name(F.col("turn")).alias("output_rid"), F.when(F.col("turn") > 0, name(F.col("turn") - 1)).alias("input_rid"), F.col("role").alias("kind"), F.length("text").alias("entities_extracted")
        )

    @cached_property
    def batches(self) -> DataFrame:
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("class_id"))
        return self.table("lineitem").join(part, "l_partkey").select(
            F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("line"), "class_id", F.col("l_returnflag").alias("flag"), F.round("l_quantity").cast("long").alias("amount"),
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("price"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("issued"), F.col("l_partkey").alias("part"),
        )

    @cached_property
    def validators(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("operator"))
        return self.table("supplier").join(nation, "s_nationkey").select(F.col("s_suppkey").alias("address"), F.round(F.col("s_acctbal") * 100).cast("long").alias("power"), "operator", F.col("s_name").alias("moniker"))

    @cached_property
    def jobs(self) -> DataFrame:
        s, k = F.col("o_orderstatus"), F.col("o_orderkey")
        state = F.when((s == "F") & (k % 5 == 0), "failed").when(s == "F", "completed").when((s == "O") & (k % 3 == 0), "retrying").when(s == "O", "queued").otherwise("running")
        return self.table("orders").select(
            k.alias("id"), F.col("o_custkey").alias("worker"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), state.alias("state"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("scheduled_for"), (F.round("o_totalprice").cast("long") % 10000).alias("seconds"), (k % 4).alias("retry_count"),
        )

    @cached_property
    def turns(self) -> DataFrame:
        return self.table("conversations").select("conv_id", "turn", "role", "text")
