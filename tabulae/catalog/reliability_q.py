"""Default write mode, releases, malformed records, ledgered ingestion and split keys on whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.catalog.io_q import DOC_COLS, DOC_SQL, _documents
from tabulae.catalog.jobs_files_q import _REGISTRY, digest, stage_register
from tabulae.catalog.sqlgen import s_digest
from tabulae.catalog.standin import table
from tabulae.operators.heavy import split_join
from tabulae.plans import registry as R
from tabulae.session import scratch_path
from tabulae.sinks import write_delimited, write_table
from tabulae.sinks.publish import read_published
from tabulae.sources.delimited import sound_and_malformed
from tabulae.sources.records import scan_records
from tabulae.streaming.ledger import ingest_files, published

Q: dict = {}


# --- K1: the default mode refuses an old table and leaves it as it is -----------------
def q_sink_default_mode(spark, sf):
    path = scratch_path(spark, "orders-default")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_table(orders, path, mode="errorifexists")
    try:
        write_table(orders.withColumn("o_orderstatus", F.lit("lost")), path, mode="errorifexists")
        refused = False
    except FileExistsError:
        refused = True
    write_table(orders.withColumn("o_orderstatus", F.lit("lost")), path, mode="ignore")
    return spark.read.parquet(path).withColumn("refused", F.lit(refused))


Q["sink_default_mode"] = (q_sink_default_mode, "SELECT o_orderkey, o_custkey, o_orderstatus, TRUE AS refused FROM orders")


# --- K2: a table that is rewritten from itself ----------------------------------------
def q_sink_replace_itself(spark, sf):
    path = scratch_path(spark, "orders-itself")
    write_table(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path)
    write_table(spark.read.parquet(path).withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return spark.read.parquet(path)


Q["sink_replace_itself"] = (q_sink_replace_itself, "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders")


# --- C9: the register as releases: one that is stopped, one that goes on with it ----------
def q_registry_release(spark, sf):
    raw, out = scratch_path(spark, "release-raw"), scratch_path(spark, "release")
    stage_register(spark, sf, raw)
    build = R.partners_table

    def stopped(*args, **kwargs):
        raise RuntimeError("stopped")

    R.partners_table = stopped
    try:
        R.run(spark, raw, out, release=True)
    except RuntimeError:
        pass        # nothing is published; the tables before the partners are whole
    finally:
        R.partners_table = build
    R.run(spark, raw, out, release=True)
    rows = [digest(name, read_published(spark, out, f"df_{name}")) for name in _REGISTRY]
    result = rows[0]
    for more in rows[1:]:
        result = result.unionByName(more)
    return result


Q["registry_release"] = (q_registry_release, " UNION ALL ".join(s_digest(n, sql, cols) for n, (sql, cols) in _REGISTRY.items()))


# --- S1: records that are too short, too long or not closed, by document number --------------
_KINDS = {1: "short", 2: "long", 3: "quotes"}


def q_scan_malformed(spark, sf):
    path = scratch_path(spark, "broken-text")
    docs = table(spark, sf, "documents")
    lang = F.concat(F.lit('"'), "lang", F.lit('"'))
    sound = F.concat_ws(";", "doc_id", lang, "source", "n_chars")
    line = (F.when(F.col("doc_id") % 10 == 1, F.concat_ws(";", "doc_id", lang)).when(F.col("doc_id") % 10 == 2, F.concat(sound, F.lit(';"more; of";it')))
            .when(F.col("doc_id") % 10 == 3, F.concat_ws(";", F.col("doc_id"), F.concat(F.lit('"'), "lang"), "source", "n_chars")).otherwise(sound))
    docs.select(line.alias("value")).write.text(path)
    good, bad = sound_and_malformed(spark, path, ["doc_id", "lang", "source", "n_chars"])
    return good.withColumn("problem", F.lit(None).cast("string")).unionByName(
        bad.select(F.col("first_field").alias("doc_id"), "problem"), allowMissingColumns=True)


Q["scan_malformed"] = (q_scan_malformed, """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN p IS NULL THEN lang END AS lang, CASE WHEN p IS NULL THEN source END AS source,
  CASE WHEN p IS NULL THEN CAST(n_chars AS VARCHAR) END AS n_chars, p AS problem
  FROM (SELECT *, CASE doc_id % 10 """ + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _KINDS.items()) + " END AS p FROM documents) d")


# --- R5: deliveries through the ledger; each language comes wrong first and is delivered again --------
_NARROW = ["doc_id", "lang", "source", "n_chars"]


def q_ingest_ledger(spark, sf):
    landing, root = scratch_path(spark, "ledger-landing"), scratch_path(spark, "ledger")
    docs = _documents(spark, sf).select(*_NARROW)
    for rows in (docs.withColumn("source", F.lit("wrong")), docs):
        # the same file names again: one folder for each language, one file in it
        staged = scratch_path(spark, "ledger-staged")
        write_delimited(rows.withColumn("folder", F.col("lang")), staged, partition_by=["folder"])
        deliver(spark, staged, landing)
        ingest_files(spark, landing, root, _NARROW, overwrite=True, max_files=2)
        ingest_files(spark, landing, root, _NARROW, overwrite=True, max_files=2)      # nothing new: nothing twice
    return published(spark, root)


Q["ingest_ledger"] = (q_ingest_ledger, "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")


def deliver(spark, staged: str, landing: str) -> None:
    """Move the staged files into the landing folder under names that do not change."""
    from tabulae.sources.hadoop import children, delete, exists, move

    for folder in children(spark, staged):
        if "=" not in folder:
            continue
        for i, name in enumerate(x for x in children(spark, f"{staged}/{folder}") if x.startswith("part-")):
            target = f"{landing}/{folder}/delivery-{i}.csv"
            if exists(spark, target):
                delete(spark, target)
            move(spark, f"{staged}/{folder}/{name}", target)


# --- J8-J10: a null-safe lookup whose keys are a third null and a third one value ----------
def q_lookup_split_keys(spark, sf):
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(None)).when(F.col("l_orderkey") % 3 == 1, F.lit(7)).otherwise(F.col("l_suppkey") % 30)
    facts = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key.cast("int").alias("nation"))
    names = table(spark, sf, "nation").select(F.col("n_nationkey").cast("int").alias("nation"), "n_name").unionByName(
        spark.createDataFrame([(None, "UNKNOWN")], "nation int, n_name string"))
    return split_join(facts, names, "nation", null_safe=True, salt_by=["l_orderkey", "l_linenumber"])


Q["lookup_split_keys"] = (q_lookup_split_keys, """SELECT l_orderkey, l_linenumber, CAST(k AS INTEGER) AS nation, CASE WHEN k IS NULL THEN 'UNKNOWN' ELSE n_name END AS n_name
  FROM (SELECT l_orderkey, l_linenumber, CASE l_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 7 ELSE l_suppkey % 30 END AS k FROM lineitem) l LEFT JOIN nation ON k = n_nationkey""")


# --- S1-S3: texts with line breaks in quotes, files read in parts --------------------------
def q_scan_split_records(spark, sf):
    path = scratch_path(spark, "split-records")
    write_delimited(_documents(spark, sf), path)
    return scan_records(spark, path, DOC_COLS)


Q["scan_split_records"] = (q_scan_split_records, DOC_SQL)
