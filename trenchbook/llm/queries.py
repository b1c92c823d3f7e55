"""Queries of the operators over whole tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trenchbook.llm import collocations, line_dedup, quality
from trenchbook.llm.chat_format import format_conversations, read_back
from trenchbook.llm.decontaminate import find_leaks
from trenchbook.llm.fingerprint import compare_with_next
from trenchbook.llm.jaccard_join import jaccard_components
from trenchbook.llm.license_scan import scan_licenses
from trenchbook.llm.near_dedup import near_duplicates
from trenchbook.llm.packing import pack
from trenchbook.llm.prefix_trie import borrow_heads, placed, trie_of, turn_rows
from trenchbook.llm.store import Store
from trenchbook.llm.suffix_dedup import remove_repeats
from trenchbook.llm.token_count import count_tokens

#: A document with more tokens than this is over the limit of a context.
TOKEN_LIMIT = 4096
#: Least score of a document that counts as good.
GOOD = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file; the package is on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes that a smaller document has as well, cut out."""
    cut = remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    counted = count_tokens(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups by two-word shingles."""
    return near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines of a three-line window that came before."""
    cut = line_dedup.cut_repeated_lines(_table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "row.text", "n_lines", "n_removed")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    documents = _table(spark, sf_dir, "documents")
    model = quality.train(documents, _table(spark, sf_dir, "labels"))
    return quality.score(documents.select("doc_id", "text"), model).select(
        "row.doc_id",
        quality.held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    compared = compare_with_next(_table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next", "n_distinct", "containment_next",
    )


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 tokens."""
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken")
    return pack(_table(spark, sf_dir, "documents"), *files)


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark passages in it."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = find_leaks(documents, _table(spark, sf_dir, "benchmark"))
    return leaks.select(
        "row.doc_id",
        "n_words",
        F.size("spans").cast("long").alias("n_spans"),
        (F.size("spans") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("spans.item_id")).alias("item_ids"),
    )


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted, and what is read back from the output."""
    said = "\\### Assistant: </turn> ok"
    odd = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    back = read_back(format_conversations(turns))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the conversations, each with up to three first turns of the one its number rounds down to."""
    store = Store(spark, "trie")
    turns, conversations = borrow_heads(placed(turn_rows(_table(spark, sf_dir, "conversations")), store))
    return trie_of(turns, conversations, store)


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language."""
    return collocations.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of similar documents by an exact join on five-word shingles."""
    return jaccard_components(_table(spark, sf_dir, "documents"), width=5, percent=80)


QUERIES = {
    "op1_suffix_dedup": suffix_dedup,
    "op2_token_count": token_count,
    "op3_near_dedup": near_dedup,
    "op4_line_dedup": repeated_lines,
    "op5_license_scan": license_scan,
    "op6_quality_score": quality_score,
    "op7_fingerprint": fingerprint,
    "op8_packing": packing,
    "op9_chat_format": chat_format,
    "op10_decontaminate": decontaminate,
    "op11_prefix_trie": prefix_trie,
    "op12_phrase_collocations": phrase_collocations,
    "op13_jaccard_join": jaccard_join,
}
ORACLE_SQL = {
    "op4_line_dedup": line_dedup.SQL,
    "op12_phrase_collocations": collocations.SQL,
}
