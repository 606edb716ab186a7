"""One registered query per operator, with the parameters its contract fixes."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from loomcart.catalog.registry import query
from loomcart.llm import (
    chat_tree,
    decontaminate,
    exact_dedup,
    html_text,
    licenses,
    merkle,
    mixing,
    periodic,
    quality,
    secrets,
    simhash,
    token_files,
    warc,
)
from loomcart.llm.common import lower_ascii, table, tokenizer
from loomcart.llm.sql import CHAT, DECONTAMINATION, EXACT_DEDUP, MERKLE, MIXING, WARC
from loomcart.session import scratch_path


@query("op1_html_text")
def op1(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op2_quality")
def op2(spark, sf_dir):
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_licenses")
def op3(spark, sf_dir):
    """Documents as files in folders by source, language and number. Every fourth stands one
    or two folders further up and is named as a licence file."""
    docs = table(spark, sf_dir, "documents")
    number = F.col("doc_id")
    above = F.coalesce(number % 4 == 0, F.lit(False))

    def part(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("unknown"))

    thousands = F.when(~above | (number % 8 == 4), F.floor(number / 1000).cast("string"))
    hundreds = F.when(~above, F.floor(number / 100).cast("string"))
    path = F.concat_ws("/", part("source"), part("lang"), thousands, hundreds,
                       F.concat(F.when(above, "LICENSE-").otherwise(""), part("doc_id"), F.lit(".txt")))
    return licenses.scan(docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text"))


@query("op4_decontamination", DECONTAMINATION)
def op4(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op5_warc", WARC)
def op5(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "warc")).drop("uri")


@query("op6_secrets")
def op6(spark, sf_dir):
    found = secrets.secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op7_token_files")
def op7(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer(), scratch_path(spark, "tokens"))


@query("op8_exact_dedup", EXACT_DEDUP)
def op8(spark, sf_dir):
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op9_simhash")
def op9(spark, sf_dir):
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("doc_id", "fingerprint", "component_id")


@query("op10_mixing", MIXING)
def op10(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "position")


@query("op11_merkle", MERKLE)
def op11(spark, sf_dir):
    """Documents one in three of which is checked with its text in lower case."""
    docs = table(spark, sf_dir, "documents")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    text = F.when(changed, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    now = merkle.leaf_digest([F.col(f) for f in merkle.FIELDS[:-1]] + [text])
    found = merkle.manifest(docs, carry={"now": now})
    folded = found.withColumn("folded", merkle.fold(F.col("now"), F.col("path")))
    return folded.select(
        "doc_id", *[merkle.as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        merkle.proof_digest(F.col("path")).alias("proof_sha256"), merkle.as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))


@query("op12_chat_tree", CHAT)
def op12(spark, sf_dir):
    """Conversations and one more, -1, whose texts look like marks of a template."""
    say = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), say.alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_tree.round_trip(rows, tokenizer())


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    return periodic.report(periodic.periodic_runs(table(spark, sf_dir, "documents"), periodic.plant))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
