"""Evidence chunks, embeddings, retrieval, and text answers."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.cleaning import first_existing, record_id
from riskweave.functions.predicates import within_last
from riskweave.functions.risk import freshness, lookup
from riskweave.functions.text import clean_evidence_text, collapse, question_text
from riskweave.operators.matching import match_phrases
from riskweave.operators.nearest import HELD, best_pairs, codes
from riskweave.operators.relational import top_k_per, union_all

# Chunk limits and retrieval weights.
MAX_CHUNK_CHARS = 2048
DEFAULT_FRESHNESS = 0.5
UNMATCHED = "__unmatched__"
FRESHNESS_BOOST = 0.15
BLEND = (0.85, 0.15)
RERANK = {"cosine": 0.45, "fresh": 0.15, "severity": 0.15, "recency": 0.10, "source": 0.10, "category": 0.05}
SEVERITY_SCORES = {"critical": 1.00, "high": 0.90, "medium": 0.55, "low": 0.30}
DRIVER_SOURCES = ("internal_risk_engine", "ofac", "cisa", "nws", "eia", "sec", "cpsc")
DRIVER_CATEGORIES = (
    "supplier_risk",
    "sanctions_compliance",
    "cyber",
    "logistics",
    "operational",
    "quality_recall",
    "weather",
    "energy",
)


def event_chunks(mart: DataFrame, as_of: str) -> DataFrame:
    """One chunk per matched event row."""
    said = lambda label, c: F.concat(F.lit(label), F.col(c))
    text = F.concat_ws(
        " | ", "source_name", "event_title", F.coalesce("event_summary", F.lit("")), said("Severity: ", "severity"),
        said("Matched supplier: ", "matched_supplier_id"), said("Match type: ", "match_type"),
        F.coalesce("event_country", F.lit("")), F.coalesce("event_region", F.lit("")),
    )
    return mart.filter(F.col("score_contribution").isNotNull()).select(
        F.concat(F.lit("EVT_"), "external_event_id").alias("chunk_id"),
        F.lit("external_event").alias("chunk_type"),
        F.col("matched_supplier_id").alias("supplier_id"),
        F.lit(None).cast("string").alias("sku_id"),
        "source_name",
        "risk_category",
        "event_date",
        "severity",
        text.alias("chunk_text"),
        freshness(F.col("event_date"), as_of).alias("freshness_weight"),
        "source_url",
        "evidence_doc_id",
    )


def explanation_chunks(explanations: DataFrame) -> DataFrame:
    """One always-fresh chunk per supplier explanation, in the shape of event chunks."""
    said = lambda label, c: F.concat(F.lit(label), F.coalesce(F.col(c).cast("string"), F.lit("")))
    text = F.concat_ws(
        " | ", said("Supplier: ", "supplier_name"), said("Risk score: ", "overall_risk_score"), said("Risk band: ", "risk_band"),
        said("Top driver: ", "top_risk_driver"), said("Driver 1: ", "driver_1_detail"), said("Driver 2: ", "driver_2_detail"),
        said("Recommended action: ", "recommended_action"),
    )
    none = F.lit(None).cast("string")
    return explanations.select(
        F.concat_ws("_", F.lit("EXP"), "supplier_id", F.col("score_date").cast("string")).alias("chunk_id"),
        F.lit("risk_explanation").alias("chunk_type"),
        "supplier_id",
        none.alias("sku_id"),
        F.lit("internal_risk_engine").alias("source_name"),
        F.lit("supplier_risk").alias("risk_category"),
        F.col("score_date").alias("event_date"),
        F.col("risk_band").alias("severity"),
        text.alias("chunk_text"),
        F.lit(1.0).alias("freshness_weight"),
        none.alias("source_url"),
        none.alias("evidence_doc_id"),
    )


def clean_chunks(chunks: DataFrame, max_chars: int = MAX_CHUNK_CHARS) -> DataFrame:
    """Whole texts as numbered parts no longer than an embedder's input, blanks collapsed, empty
    parts dropped, stable id."""
    text = F.coalesce(first_existing(chunks, ["chunk_text_clean", "chunk_text"]), F.lit(""))
    parts = F.ceil(F.length(text) / max_chars).cast("int")
    x = chunks.select(
        first_existing(chunks, ["chunk_id"]).alias("original_chunk_id"),
        *[first_existing(chunks, [c]).alias(c) for c in ("chunk_type", "supplier_id", "sku_id", "source_name", "risk_category", "severity", "source_url", "evidence_doc_id")],
        first_existing(chunks, ["event_date"], "date").alias("event_date"),
        F.coalesce(first_existing(chunks, ["freshness_weight"], "float"), F.lit(DEFAULT_FRESHNESS).cast("float")).alias("freshness_weight"),
        F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1), lambda n: F.substring(text, n * max_chars + 1, F.lit(max_chars)))).alias("part", "_text"),
    ).withColumn("chunk_text_clean", collapse(F.col("_text"))).drop("_text")
    return x.filter(F.length("chunk_text_clean") > 0).withColumn(
        "chunk_id", record_id("original_chunk_id", "supplier_id", "sku_id", "source_name", "risk_category", "event_date", "part")
    )


Embedder = Callable[[list[str]], np.ndarray]


def hashing_embedder(dim: int = 64) -> Embedder:
    """Deterministic bag-of-words vectors by feature hashing, for runs without a model."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float64)
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = zlib.crc32(word.encode("utf-8"))
                out[i, h % dim] += 1.0 if (h >> 16) & 1 else -1.0
        return out

    return embed


def embed_chunks(chunks: DataFrame, embedder: Embedder, model: str, dim: int, batch: int = 64) -> DataFrame:
    """Chunk text to unit vectors on the executors, ``batch`` texts per call of the embedder."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            parts = [embedder(pdf["chunk_text_clean"].iloc[i : i + batch].tolist()) for i in range(0, len(pdf), batch)]
            if not parts:
                continue
            vectors = np.vstack(parts)
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            unit = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
            yield pd.DataFrame({"chunk_id": pdf["chunk_id"], "embedding": list(unit.astype("float32"))})

    return chunks.select("chunk_id", "chunk_text_clean").mapInPandas(run, "chunk_id string, embedding array<float>").withColumns(
        {"embedding_model": F.lit(model), "embedding_dim": F.lit(dim)}
    )


def retrieval_index(embedded: DataFrame, as_of: str) -> DataFrame:
    """Search metadata without vectors; rows without a supplier share one partition value."""
    day = F.lit(as_of).cast("date")
    parts = ("chunk_type", "supplier_id", "sku_id", "source_name", "risk_category", "severity")
    return embedded.withColumns(
        {
            "supplier_id_partition": F.coalesce("supplier_id", F.lit(UNMATCHED)),
            "is_fresh": F.coalesce(within_last(F.col("event_date"), as_of, 30), F.lit(False)),
            "is_critical_or_high": F.coalesce(F.lower("severity").isin("critical", "high"), F.lit(False)),
            "days_since_event": F.datediff(day, "event_date"),
            "retrieval_text": F.concat_ws(" | ", *[F.coalesce(p, F.lit("")) for p in parts]),
        }
    ).drop("embedding")


_TEXT_LAST = ("chunk_text", "source_url", "evidence_doc_id")


def _with_texts(ranked: DataFrame, index: DataFrame) -> DataFrame:
    """Texts are fetched for the winners only."""
    return ranked.join(index.select("chunk_id", *[c for c in _TEXT_LAST if c in index.columns]), "chunk_id")


def _fresh() -> Column:
    return F.coalesce(F.col("freshness_weight").cast("double"), F.lit(DEFAULT_FRESHNESS))


def _filters_hold(asked: pa.StructArray, about: pa.StructArray) -> np.ndarray:
    """Which chunks (columns) pass all filters of which queries (rows); NULL filters are off."""
    sku, of_sku = codes(asked.field("sku_id"), about.field("sku_id"))
    ok = (sku == -1)[:, None] | (of_sku == -1) | (sku[:, None] == of_sku)
    category, of_category = codes(asked.field("risk_category"), about.field("risk_category"))
    ok &= (category == -1)[:, None] | (category[:, None] == of_category)
    since, day = (x.cast(pa.int32()) for x in (asked.field("since"), about.field("event_date")))
    late = day.fill_null(np.iinfo(np.int32).min).to_numpy() >= since.fill_null(0).to_numpy()[:, None]
    ok &= since.is_null().to_numpy(zero_copy_only=False)[:, None] | (late & day.is_valid().to_numpy(zero_copy_only=False))
    lists = asked.field("severities")
    wanted, have = codes(lists.flatten(), about.field("severity"))
    allowed = np.zeros((len(lists), max(wanted.max(initial=-1), have.max(initial=-1)) + 2), bool)
    allowed[pc.list_parent_indices(lists).to_numpy(), wanted] = True
    allowed[:, -1] = False  # NULL is in no list
    return ok & (lists.is_null().to_numpy(zero_copy_only=False)[:, None] | allowed[:, have])


def _retrieval(mode: str):
    def judge(asked: pa.StructArray, about: pa.StructArray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fresh = about.field("freshness_weight").to_numpy()
        score = cosine * (1 + FRESHNESS_BOOST * fresh) if mode == "boost" else BLEND[0] * cosine + BLEND[1] * fresh
        return score, _filters_hold(asked, about)

    return judge


def retrieve(queries: DataFrame, index: DataFrame, as_of: str, k: int, mode: str = "boost", salts: int | None = None, held: int = HELD) -> DataFrame:
    """Best ``k`` chunks per query.

    ``queries``: query_id, supplier_id, sku_id, risk_category, window_days, severities,
    query_embedding (NULL filters are off). A query sees the chunks of its supplier and those without
    one; with no chunk under all its filters it is widened to all of these. ``mode`` 'boost' scores
    cosine x (1 + 0.15 x freshness), 'blend' 0.85 x cosine + 0.15 x freshness. Ties go to the smaller
    chunk id. Chunks and queries without a whole vector are not ranked, but such a chunk under all
    filters keeps its query from being widened.

    Scores come from block products (``operators.nearest``), so the index is read once for these and
    once for the texts of the winners.
    """
    if mode not in ("boost", "blend"):
        raise ValueError(f"unknown mode {mode}")
    since = F.when(F.col("window_days") > 0, F.date_sub(F.lit(as_of).cast("date"), F.col("window_days")))
    q = queries.select(
        "query_id",
        F.array("supplier_id", F.lit(UNMATCHED)).alias("scopes"),
        F.col("query_embedding").alias("vector"),
        F.struct(
            F.col("sku_id").cast("string").alias("sku_id"), F.col("risk_category").cast("string").alias("risk_category"), since.alias("since"),
            F.col("severities").cast("array<string>").alias("severities"),
        ).alias("asked"),
    )
    i = index.select(
        F.col("chunk_id").alias("item_id"),
        F.coalesce("supplier_id", F.lit(UNMATCHED)).alias("scope"),
        F.col("embedding").alias("vector"),
        F.struct(
            F.col("sku_id").cast("string").alias("sku_id"), F.col("risk_category").cast("string").alias("risk_category"),
            F.col("event_date").cast("date").alias("event_date"), F.col("severity").cast("string").alias("severity"), "source_name", "supplier_id", _fresh().alias("freshness_weight"),
        ).alias("about"),
    )
    found = best_pairs(q, i, k, _retrieval(mode), salts=salts, held=held)
    # An unrankable chunk that passes the filters stands behind all that do and before all that do not.
    order = [F.desc("strict"), F.col("item_id").isNull().asc(), F.desc("score"), F.asc("item_id")]
    best = top_k_per(found, ["query_id"], order, k, rank_col="evidence_rank")
    best = best.withColumn("_strict", F.max("strict").over(W.partitionBy("query_id"))).filter("item_id IS NOT NULL AND strict = _strict")
    names = ("source_name", "risk_category", "event_date", "severity", "supplier_id", "sku_id", "freshness_weight")
    ranked = best.select(
        "query_id", F.col("item_id").alias("chunk_id"), *[F.col(f"about.{n}") for n in names], F.col("cosine").alias("semantic_score"),
        F.col("score").alias("retrieval_score"), (~F.col("strict")).alias("widened"), "evidence_rank",
    )
    return _with_texts(ranked, index)


def _reranking(asked: pa.StructArray, about: pa.StructArray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return RERANK["cosine"] * cosine + about.field("base").to_numpy(), np.ones(cosine.shape, bool)


def rerank(queries: DataFrame, index: DataFrame, as_of: str, k: int = 8, salts: int | None = None, held: int = HELD) -> DataFrame:
    """Business re-ranking: all chunks of the query's supplier, scored by similarity, freshness,
    severity, recency, source and category. All but the similarity is a property of the chunk and is
    computed once per chunk."""
    age = F.datediff(F.lit(as_of).cast("date"), "event_date")
    facts = {
        "fresh": _fresh(),
        "severity_score": lookup(F.lower("severity"), SEVERITY_SCORES, 0.40),
        "recency_score": F.when(age.isNull(), F.lit(0.35)).when(age <= 30, F.lit(1.0)).when(age <= 90, F.lit(0.85)).when(age <= 365, F.lit(0.65)).otherwise(F.lit(0.25)),
        "driver_source_score": F.coalesce(F.lower("source_name").isin(*DRIVER_SOURCES).cast("double"), F.lit(0.0)),
        "driver_category_score": F.coalesce(F.lower("risk_category").isin(*DRIVER_CATEGORIES).cast("double"), F.lit(0.0)),
    }
    weights = dict(zip(facts, (RERANK[w] for w in ("fresh", "severity", "recency", "source", "category"))))
    base = reduce(lambda a, b: a + b, [w * F.col(c) for c, w in weights.items()])
    shown = ("source_name", "risk_category", "event_date", "severity")
    q = queries.select("query_id", F.array("supplier_id").alias("scopes"), F.col("query_embedding").alias("vector"), F.struct("supplier_id").alias("asked"))
    i = index.withColumns(facts).select(
        F.col("chunk_id").alias("item_id"), F.col("supplier_id").alias("scope"), F.col("embedding").alias("vector"),
        F.struct("supplier_id", *shown, *facts, base.alias("base")).alias("about"),
    )
    ties = ["driver_source_score", "severity_score", "recency_score"]
    found = best_pairs(q, i, k, _reranking, ties, salts, held).filter("item_id IS NOT NULL")
    order = [F.desc("score"), *[F.desc(f"about.{c}") for c in ties], F.desc("cosine"), F.asc("item_id")]
    best = top_k_per(found, ["query_id"], order, k, rank_col="evidence_rank")
    ranked = best.select(
        "query_id", F.col("about.supplier_id"), F.col("item_id").alias("chunk_id"), *[F.col(f"about.{c}") for c in shown], F.col("cosine").alias("cosine_similarity"),
        *[F.col(f"about.{c}") for c in facts], F.col("score").alias("business_retrieval_score"), "evidence_rank",
    )
    return _with_texts(ranked, index)


def format_evidence(ranked: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Numbered evidence block per query; lists hold at most the retrieved k entries."""
    line = F.concat(
        F.lit("["), F.col("evidence_rank").cast("string"), F.lit("] "), F.coalesce("source_name", F.lit("Unknown")), F.lit(" · "),
        F.coalesce(F.col("event_date").cast("string"), F.lit("N/A")), F.lit(" | Severity: "), F.coalesce("severity", F.lit("N/A")), F.lit("\n  "),
        clean_evidence_text(F.col("chunk_text"), max_chars),
    )
    packed = F.array_sort(F.collect_list(F.struct("evidence_rank", line.alias("line"))))
    return ranked.groupBy("query_id").agg(packed.alias("_e")).select(
        "query_id",
        F.size("_e").alias("evidence_count"),
        F.concat(F.lit("## Retrieved Evidence\n"), F.array_join(F.transform("_e", lambda s: s["line"]), "\n")).alias("evidence_block"),
    )


def resolve_entity(questions: DataFrame, suppliers: DataFrame, common_df: int = 100, keep=lambda d, label="": d) -> DataFrame:
    """Best supplier for each question: id, then full name, then first word, then word overlap.

    A first word shared by many suppliers stands for its smallest id only, as that one would
    win. Overlap is exact without pairing everything: words of at most ``common_df`` suppliers
    pair directly; suppliers that share only common words with a question are represented by
    the smallest id of each (common words, word count) class.
    """
    q = questions.select("question_id", "question", question_text(F.col("question")).alias("qn"))
    s = suppliers.select("supplier_id", "supplier_name", question_text(F.col("supplier_name")).alias("sn"))
    raw = F.upper(F.replace(F.regexp_extract("question", r"(?i)\bSUP[_-]?\d+\b", 0), F.lit("-"), F.lit("_")))
    given = F.when(raw != "", F.when(raw.startswith("SUP_"), raw).otherwise(F.concat(F.lit("SUP_"), F.substring(raw, 4, 1000))))
    by_id = q.select("question_id", given.alias("_id")).join(s.select("supplier_id", F.upper("supplier_id").alias("_id")), "_id").select(
        "question_id", "supplier_id", F.lit(1.0).alias("confidence"), F.lit("explicit_supplier_id").alias("resolution_method")
    )
    first = F.split("sn", " ")[0]
    phrases = (
        s.select("sn", "supplier_id", F.lit(0.95).alias("confidence"), F.lit("supplier_name_exact_substring").alias("resolution_method"))
        .unionByName(
            s.filter(F.length(first) >= 5).select(first.alias("sn"), "supplier_id", F.lit(0.85).alias("confidence"), F.lit("supplier_name_first_token").alias("resolution_method"))
        )
        .groupBy("sn", "confidence", "resolution_method")
        .agg(F.min("supplier_id").alias("supplier_id"))
    )
    hits = match_phrases(q.select(F.col("question_id").alias("text_id"), F.col("qn").alias("text")), phrases.select(F.col("sn").alias("phrase")))
    by_name = hits.join(phrases, hits.phrase == phrases.sn).select(F.col("text_id").alias("question_id"), "supplier_id", "confidence", "resolution_method")

    words = lambda c: F.filter(F.array_distinct(F.split(c, " ")), lambda w: w != "")
    cand = s.select("supplier_id", words(question_text(F.concat_ws(" ", "supplier_id", "supplier_name"))).alias("ws"))
    cand = cand.select("supplier_id", F.size("ws").alias("n"), F.explode("ws").alias("w"))
    freq = cand.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    cand = keep(cand.join(freq, "w").withColumn("common", F.col("df") > common_df), "entity_words")
    qw = keep(q.select("question_id", F.explode(words(F.col("qn"))).alias("w")), "question_words")
    near = qw.join(cand.filter(~F.col("common")), "w").select("question_id", "supplier_id").distinct()
    overlap = near.join(cand, "supplier_id").join(qw, ["question_id", "w"], "left_semi")
    rare = overlap.groupBy("question_id", "supplier_id", "n").agg(F.count(F.lit(1)).alias("m"))
    classes = (
        cand.filter("common")
        .groupBy("supplier_id", "n")
        .agg(F.array_sort(F.collect_set("w")).alias("ws"))
        .groupBy("ws", "n")
        .agg(F.min("supplier_id").alias("supplier_id"))
        .select("supplier_id", "n", F.explode("ws").alias("w"))
    )
    common = qw.join(classes, "w").groupBy("question_id", "supplier_id", "n").agg(F.count(F.lit(1)).alias("m"))
    by_overlap = rare.unionByName(common).select(
        "question_id", "supplier_id", (F.col("m") / F.col("n")).alias("confidence"), F.lit("token_overlap").alias("resolution_method")
    )
    tier = {"explicit_supplier_id": 1, "supplier_name_exact_substring": 2, "supplier_name_first_token": 2, "token_overlap": 3}
    every = union_all([by_id, by_name, by_overlap]).withColumn("_tier", lookup(F.col("resolution_method"), tier, 9))
    best = top_k_per(every, ["question_id"], [F.asc("_tier"), F.desc("confidence"), F.asc("supplier_id")], 1).drop("_tier")
    return (
        q.select("question_id", "question")
        .join(best, "question_id", "left")
        .join(s.select("supplier_id", "supplier_name"), "supplier_id", "left")
        .select(
            "question_id",
            "supplier_id",
            "supplier_name",
            F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
            F.coalesce(
                "resolution_method", F.when(F.trim(F.coalesce("question", F.lit(""))) == "", F.lit("empty_question")).otherwise(F.lit("unresolved"))
            ).alias("resolution_method"),
        )
    )


def with_evidence_documents(events: DataFrame, documents: DataFrame) -> DataFrame:
    """Events with the id of the document that holds their payload."""
    d = documents.select("api_run_id", F.col("payload_hash").alias("source_payload_hash"), "evidence_document_id")
    return events.join(d, ["api_run_id", "source_payload_hash"], "left")


def event_lines(events: str = "active_external_events") -> Column:
    """A snapshot's ranked events as lines of text."""
    said = lambda e, c, other: F.coalesce(e[c].cast("string"), F.lit(other))
    return F.transform(
        events, lambda e: F.concat(said(e, "event_title", "Untitled event"), F.lit(" ("), said(e, "severity", "unknown"), F.lit(", "), said(e, "event_date", "undated"), F.lit(")"))
    )


def evidence_lines(events: str = "active_external_events") -> Column:
    """Where each of a snapshot's ranked events is documented, numbered like the events."""
    said = lambda e, c, other: F.coalesce(e[c].cast("string"), F.lit(other))
    return F.transform(
        events,
        lambda e: F.concat(
            F.lit("["), e["event_rank"].cast("string"), F.lit("] "), said(e, "source_name", "unknown source"), F.lit(" · "), said(e, "evidence_document_id", "no document"),
            F.lit(" · "), said(e, "source_url", "no link"),
        ),
    )


def context_packet(resolved: DataFrame, snapshot: DataFrame, evidence: DataFrame) -> DataFrame:
    """Question, supplier snapshot and its evidence as one row with a JSON packet."""
    joined = resolved.join(snapshot, "supplier_id", "left").join(evidence, "supplier_id", "left")
    fields = [c for c in joined.columns if c != "question_id"]
    return joined.select("question_id", *fields, F.to_json(F.struct(*[F.col(f) for f in fields])).alias("packet_json"))


def templated_answer(packets: DataFrame) -> DataFrame:
    """Grounded answer text from a packet with the columns of a context snapshot.

    The first sentence corrects a question that presumes a high risk band. All lines the packet
    holds are listed.
    """
    num = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("0"))
    presumes = F.lower("question").contains("high risk") & ~F.lower(F.coalesce("risk_band", F.lit(""))).isin("high", "critical")
    listed = lambda title, c: F.when(F.size(c) > 0, F.concat(F.lit(f"{title}:\n- "), F.array_join(c, "\n- ")))
    known = F.concat_ws(
        "\n",
        F.when(presumes, F.concat("supplier_name", F.lit(" is not classified as high risk; it is classified as "), "risk_band", F.lit("."))),
        F.concat("supplier_name", F.lit(" ("), "supplier_id", F.lit(") has a risk score of "), F.format_string("%.1f", F.col("overall_risk_score")), F.lit(" and is in the "), "risk_band", F.lit(" risk band.")),
        F.concat(F.lit("Top risk driver: "), "top_risk_driver"),
        F.concat(F.lit("Active events: "), num("event_count"), F.lit("; affected SKUs: "), num("sku_count"), F.lit("; open alerts: "), num("alert_count")),
        listed("Top events", "event_lines"),
        listed("Affected SKUs", "sku_lines"),
        listed("Evidence", "evidence_lines"),
        F.concat(F.lit("Recommendation: "), "recommended_action"),
    )
    unknown = F.lit("Could not identify the supplier. Please include a supplier ID or a specific supplier name.")
    return packets.withColumn("final_answer", F.when(F.col("supplier_id").isNotNull(), known).otherwise(unknown))
