"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, langid, lexical, media, packing, pii, sharding, simhash, tokenstore, urlfilter, warc, whitening
from .bpe import tokenizer_path
from .common import table, written


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, verbatim or with other numbers, names or units, with the item."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_model_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return urlfilter.judge(table(spark, sf_dir, "pages")).withColumn("score", F.round("score", 6) + F.lit(0.0))


def op3_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component of its links."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _measures(stored: bytes, payload: bytes) -> tuple:
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), media.feature(payload)


def op4_interleaved_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page whose figures show the text, stored as an image and described as read back.

    Each page also has text runs, an image that the store doesn't hold, and its figure
    twice; sequence tells its elements in order, with captions and whether they resolved.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A row of its own for each document row, should ids repeat.
    store = media.store_media(docs.select(F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("id"), "text"))
    title = F.coalesce(F.col("id.doc_id").cast("string"), F.lit("none"))
    html = media.illustrated(title, F.col("digest"), F.reverse("digest"))
    pages = media.interleaved(store.select("id", "n_bytes", html.alias("html")))
    found = written(media.described(store, _measures, "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"), "media-features")
    whole = media.resolve(pages, found)
    shown = F.filter("elements", lambda e: e["caption"].startswith("figure 1 of "))[0]["media"]
    told = lambda e: F.concat_ws(":", e["pos"].cast("string"), e["kind"], F.coalesce(e["caption"], e["text"]), F.when(e["kind"] == "media", F.when(e["media"].isNull(), "absent").otherwise("resolved")))
    return whole.select("id.doc_id", "n_bytes", shown.alias("m"), F.array_join(F.transform("elements", told), "|").alias("sequence")).select("doc_id", "n_bytes", "m.*", "sequence")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, equal texts together."""
    return sharding.assign(table(spark, sf_dir, "documents"), 40).withColumn("grown_shard", F.lit(None).cast("int"))


def op7_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base spans, and all spans."""
    return pii.scan(table(spark, sf_dir, "documents"))


def op8_bit_plane_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written in plane files and indexed as read back."""
    return tokenstore.document_index(tokenstore.write_store(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op9_hashed_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, its score and whether it is rejected."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs)
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (langid.fold(F.col("doc_id")) == langid.HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")


#: One more conversation of the query: it holds the template's own marks.
MARKED = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op10_reply_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's best branch as one formatted text, described as read back from the written output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(MARKED, "conv_id long, turn long, role string, text string"))
    nodes = written(chat.linear_nodes(rows), "chat-nodes")
    best = chat.rank_branches(nodes).filter("branch_rank = 1")
    output = written(chat.format_paths(best, nodes), "chat")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for conv, formatted, spans in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                turns = chat.parse(formatted)
                loss = "".join(chat.unescape(formatted[s["start"] : s["end"]]) for s in spans)
                sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), loss)]
                out.append((conv, len(turns), sha[0], len(loss), sha[1], len(formatted)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return output.select("tree", "formatted", "loss_spans").mapInArrow(described, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op11_blocked_sparse_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item, its terms taken once each."""
    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), lexical.TOP, once=True)


def op12_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding's first 32 whitened components, and how they were fitted."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture read back from archives: payload, record type and what it revisits."""
    return warc.page_index(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_template_decontamination": op1_template_decontamination,
    "op2_url_model_filter": op2_url_model_filter,
    "op3_simhash_components": op3_simhash_components,
    "op4_interleaved_media": op4_interleaved_media,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_minimax_shards": op6_minimax_shards,
    "op7_semi_markov_pii": op7_semi_markov_pii,
    "op8_bit_plane_store": op8_bit_plane_store,
    "op9_hashed_subword_language": op9_hashed_subword_language,
    "op10_reply_tree_chat": op10_reply_tree_chat,
    "op11_blocked_sparse_search": op11_blocked_sparse_search,
    "op12_jacobi_whitening": op12_jacobi_whitening,
    "op13_warc_captures": op13_warc_captures,
}

_OP10_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(regexp_replace(role || text, '[\\<>]', '__', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

SQL: dict[str, str] = {"op13_warc_captures": warc.INDEX_SQL, "op11_blocked_sparse_search": lexical.SEARCH_SQL, "op10_reply_tree_chat": _OP10_SQL, "op2_url_model_filter": urlfilter.judge_sql()}
