"""Sources and sinks over whole tables: a table is landed in the shared folder in the source's format and read back, or written and read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import content, kg
from ..sources import readers, writers
from .registry import query
from .streams import shared_base
from .views import Views


def _text(df: DataFrame, path: str, *by: str) -> None:
    """Text as it is; with ``by`` a file for each row's values."""
    (df.write.partitionBy(*by) if by else df.coalesce(3).write).text(path)


@query("src_02_feed_entries", "select p_name as title, 'https://feeds.example/' || p_partkey as link, p_type || ' & <' || p_brand || '>' as description, '2024-01-0' || (1 + p_partkey % 9) as published from part")
def feed(v: Views) -> DataFrame:
    base = shared_base(v.spark)
    p = v.table("part")
    items = p.select(F.col("p_name").alias("title"), F.concat(F.lit("https://feeds.example/"), "p_partkey").alias("link"), F.concat("p_type", F.lit(" & <"), "p_brand", F.lit(">")).alias("description"), F.concat(F.lit("2024-01-0"), 1 + F.col("p_partkey") % 9).alias("pubDate"))
    items.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(f"{base}/feed")
    return readers.read_feed(v.spark, f"{base}/feed").select("title", "link", "description", "published")


def _mail(k, name, subject, body):
    return F.concat(F.lit("Message-ID: <"), k, F.lit('@x.example>\nFrom: "'), name, F.lit('" <u'), k, F.lit("@x.example>\nTo: a@y.example, B <b@y.example>\nSubject: "), subject, F.lit("\nDate: Mon, 01 Jan 2024 10:00:00 +0100\n"), body)


@query("src_04_mbox", "select '<' || c_custkey || '@x.example>' as message_id, 'u' || c_custkey || '@x.example' as from_address, c_name as from_name, 'On ' || c_mktsegment as subject, '2024-01-01T10:00:00+01:00' as date_sent, 2 as recipients from customer")
def mbox(v: Views) -> DataFrame:
    base, k = shared_base(v.spark), F.col("c_custkey")
    _text(v.table("customer").select(F.concat(F.lit("From u@x Mon Jan  1 10:00:00 2024\n"), _mail(k, F.col("c_name"), F.concat(F.lit("On "), "c_mktsegment"), F.lit("\nHello,\n> From here\nbye\n")))), f"{base}/mbox")
    return readers.read_mbox(v.spark, f"{base}/mbox").select("message_id", "from_address", "from_name", "subject", "date_sent", F.size("to_addresses").alias("recipients"))


_PARTS = '\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="B"\n\n--B\nContent-Type: text/plain; charset="utf-8"\n\nBalance of '


def _maildir(v: Views, folders: int = 64) -> str:
    """A file for each supplier: a text and an attachment with its balance. A folder holds the files of many and is written by one task, so
    that the commit moves folders and not files, and that folders are listed side by side."""
    base, k = shared_base(v.spark), F.col("s_suppkey")
    sheet = F.concat(F.lit('\n--B\nContent-Type: text/csv\nContent-Disposition: attachment; filename="s-'), k, F.lit('.csv"\n\nkey,'), k, F.lit("\n--B--\n"))
    body = F.concat(F.lit(_PARTS.removeprefix("\n")), "s_name", sheet)
    mail = v.table("supplier").select(F.pmod(F.hash(k), F.lit(folders)).alias("folder"), _mail(k, F.col("s_name"), F.lit("Sheet"), body).alias("value"))
    mail.repartition(folders, "folder").write.partitionBy("folder").option("maxRecordsPerFile", 1).text(f"{base}/mail")
    return f"{base}/mail/*"


@query("src_05_maildir", "select '<' || s_suppkey || '@x.example>' as message_id, s_name as from_name, 'Balance of ' || s_name as body, 1 as attachments from supplier")
def maildir(v: Views) -> DataFrame:
    return readers.read_maildir(v.spark, _maildir(v), "*.txt").select("message_id", "from_name", F.trim(F.regexp_replace("body", r"\s+$", "")).alias("body"), "attachments")


@query("src_17_attachments", "select '<' || s_suppkey || '@x.example>' as message_id, 0 as place, 's-' || s_suppkey || '.csv' as name, 'text/csv' as content_type, length('key,' || s_suppkey) as size, sha256('key,' || s_suppkey) as sha256 from supplier")
def attachments(v: Views) -> DataFrame:
    return readers.read_attachments(v.spark, _maildir(v), "*.txt").select("message_id", "place", "name", "content_type", "size", "sha256")


@query("src_07_repository", "select '# ' || n_name || chr(10) || 'of region ' || n_regionkey || chr(10) as content from nation")
def repository(v: Views) -> DataFrame:
    base = shared_base(v.spark)
    _text(v.table("nation").select("n_nationkey", F.concat(F.lit("# "), "n_name", F.lit("\nof region "), "n_regionkey").alias("value")), f"{base}/repo", "n_nationkey")
    return readers.read_repository(v.spark, f"{base}/repo").select("content")


@query("src_13_transcripts", "select role as type, 'c' || conv_id as cwd, md5(text) as digest from conversations where turn % 5 <> 4 and role in ('user', 'assistant')")
def transcripts(v: Views) -> DataFrame:
    """Session lines; every fifth is cut off and so no JSON."""
    base = shared_base(v.spark)
    line = F.to_json(F.struct(F.col("role").alias("type"), F.concat(F.lit("c"), "conv_id").alias("cwd"), F.struct(F.lit("m").alias("model"), F.col("text").alias("content")).alias("message")))
    _text(v.turns.select(F.when(F.col("turn") % 5 == 4, F.concat(F.lit('{"type": "'), "role", F.lit('", '))).otherwise(line)), f"{base}/sessions")
    return readers.read_transcripts(v.spark, f"{base}/sessions").select("type", "cwd", F.md5("message.content").alias("digest"))


@query("src_15_json_folder", "select n_name as title, n_regionkey as region from nation")
def json_folder(v: Views) -> DataFrame:
    base = shared_base(v.spark)
    v.table("nation").select("n_nationkey", F.col("n_name").alias("title"), F.col("n_regionkey").alias("region")).write.partitionBy("n_nationkey").json(f"{base}/docs")
    return readers.read_documents(v.spark, f"{base}/docs", "title string, region long", ("schema", "index")).select("title", "region")


@query("src_16_entity_lines", "select p_type as entity_type, p_name as value, (p_size % 10) / 10.0::double as confidence, p_brand as brand from part where p_partkey % 7 <> 3")
def entity_lines(v: Views) -> DataFrame:
    """Entity lines; every seventh is malformed."""
    base = shared_base(v.spark)
    line = F.to_json(F.struct(F.col("p_type").alias("entity_type"), F.col("p_name").alias("value"), (F.col("p_size") % 10 / 10.0).cast("double").alias("confidence"), F.create_map(F.lit("brand"), "p_brand").alias("properties")))
    _text(v.table("part").select(F.when(F.col("p_partkey") % 7 == 3, F.concat(F.lit("{broken "), "p_name")).otherwise(line)), f"{base}/lines")
    return readers.read_entities(v.spark, f"{base}/lines").select("entity_type", "value", "confidence", F.col("properties")["brand"].alias("brand"))


@query("snk_01_turtle", "select '<x:' || s_suppkey || '> rdfs:label \"' || s_name || '\" .' as line from supplier")
def turtle(v: Views) -> DataFrame:
    base = shared_base(v.spark)
    kg.write_turtle(v.table("supplier").select(F.concat(F.lit("<x:"), "s_suppkey", F.lit(">")).alias("s"), F.lit("rdfs:label").alias("p"), F.concat(F.lit('"'), "s_name", F.lit('"')).alias("o")), f"{base}/ttl")
    return v.spark.read.text(f"{base}/ttl").withColumnRenamed("value", "line")


@query("snk_02_entity_files", "select p_brand as entity_type, p_name as value, p_partkey as id from part")
def entity_files(v: Views) -> DataFrame:
    """Entity lines in a folder for each type."""
    base = shared_base(v.spark)
    writers.write_entities(v.table("part").select(F.col("p_brand").alias("entity_type"), F.col("p_name").alias("value"), F.col("p_partkey").alias("id")), f"{base}/types")
    return v.spark.read.schema("value string, id long, entity_type string").json(f"{base}/types").select("entity_type", "value", "id")


@query("snk_06_metrics_file", "select kind, count(*) as events, count(distinct rid) as keys from log group by 1", "log")
def metrics_file(v: Views) -> DataFrame:
    base = shared_base(v.spark)
    writers.write_metrics(v.log.groupBy("kind").agg(F.count("*").alias("events"), F.countDistinct("rid").alias("keys")), f"{base}/metrics")
    return v.spark.read.schema("kind string, events long, keys long").json(f"{base}/metrics")


@query("snk_07_provenance_append", "select output_rid, kind from receipts", "receipts")
def provenance_append(v: Views) -> DataFrame:
    """Receipts appended in two goes, by the parity of their turns."""
    base = shared_base(v.spark)
    for k in range(2):
        writers.append(v.receipts.where(F.col("turn") % 2 == k).select("output_rid", "kind"), f"{base}/receipts")
    return v.spark.read.parquet(f"{base}/receipts")


@query("snk_08_calendar_chunks", """
with e as (select o_orderkey as uid, o_orderkey % 3 as sequence, 'Order ' || o_orderkey || chr(10) || repeat(o_orderpriority || ' ', (1 + o_orderkey % 40)::integer) as body from orders)
select uid, sequence, i as index, substr(body, i * 100 + 1, 100) as chunk from e, unnest(generate_series(0, (length(body) - 1) // 100)) g(i)""")
def calendar_chunks(v: Views) -> DataFrame:
    """Event texts in pieces of 100 characters under their uid, written a partition of keys at a time and replaced by the same."""
    base, k = shared_base(v.spark), F.col("o_orderkey")
    events = v.table("orders").select(k.alias("uid"), (k % 3).alias("sequence"), F.concat(F.lit("Order "), k).alias("summary"), F.repeat(F.concat("o_orderpriority", F.lit(" ")), (1 + k % 40).cast("int")).alias("description"), F.lit("CONFIRMED").alias("status"))
    chunks, _ = writers.calendar_rows(events, 100)
    for _ in range(2):
        writers.replace_children(chunks.withColumn("bucket", F.col("uid") % 4), f"{base}/chunks", "bucket")
    return v.spark.read.parquet(f"{base}/chunks").select("uid", "sequence", "index", "chunk")


_PAGES_SQL = """pages as (select distinct p_brand as brand, p_partkey // 20 as page from part), numbered as (select *, row_number() over (partition by brand order by page) - 1 as n from pages), landed as (select * from numbered where not (n > 0 and (page + ascii(right(brand, 1))) % 23 = 0)),
 cut as (select brand, min(n) as first from numbered where n > 0 and (page + ascii(right(brand, 1))) % 23 = 0 group by 1)"""


def _pages(v: Views) -> tuple[DataFrame, DataFrame]:
    """Each brand's parts as response pages, 20 numbers each, with the key of the next one; some pages did not land."""
    from pyspark.sql import Window

    p = v.table("part").select(F.col("p_brand").alias("brand"), F.expr("p_partkey div 20").alias("page")).distinct()
    w = Window.partitionBy("brand").orderBy("page")
    n = p.select("brand", "page", F.row_number().over(w).alias("n"), F.lead("page").over(w).cast("string").alias("next_key")).withColumn("key", F.when(F.col("n") == 1, "").otherwise(F.col("page").cast("string")))
    landed = n.where(~((F.col("n") > 1) & ((F.col("page") + F.ascii(F.substring("brand", -1, 1))) % 23 == 0)))
    return content.follow_pages(landed, "brand", "key", "next_key")


@query("src_12_followed_pages", f"with {_PAGES_SQL} select l.brand, count(*) as pages, max(page) as last from landed l left join cut using (brand) where first is null or n < first group by 1")
def followed_pages(v: Views) -> DataFrame:
    """The pages of each chain that its next keys lead to."""
    return _pages(v)[0].groupBy("brand").agg(F.count("*").alias("pages"), F.max("page").alias("last"))


@query("src_12_page_gaps", f"with {_PAGES_SQL} select brand, page::varchar as missing from numbered join cut using (brand) where n = first")
def page_gaps(v: Views) -> DataFrame:
    """The keys at which chains break off."""
    return _pages(v)[1]
