"""Registered queries of the training-data operators: thin calls of the
operators over whole tables, and digest columns derived from their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from optlake.llm.common import Scratch, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        return run

    return wrap


@query("op1_minhash_neardup")
def op1_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    from optlake.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark), size=2)


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    from optlake.llm.pii import find_pii, train_tagger

    docs = table(spark, sf_dir, "documents")
    return find_pii(docs, train_tagger(docs))


@query("op3_lm_difference")
def op3_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document; the target is what is labelled of good quality."""
    from optlake.llm.lm import score_by_words

    wanted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return score_by_words(table(spark, sf_dir, "documents"), wanted, Scratch(spark))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels are learnt from rows that are not held out."""
    from optlake.llm.toxicity import fit, held_out, score_toxicity

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic"), Scratch(spark))
    return score_toxicity(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op5_url_templates")
def op5_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page url."""
    from optlake.llm.urls import judge_urls, page_labels

    return judge_urls(table(spark, sf_dir, "pages"), page_labels(table(spark, sf_dir, "labels")), Scratch(spark))


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the bytes they decode to, as digests."""
    import public_tokenizers

    from optlake.llm.bpe import encode_decode, load_ranks

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode_decode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, Scratch(spark),
                         with_ids=False, with_decoded=False)


@query("op7_licenses")
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence findings of every document."""
    from optlake.llm.licenses import scan_licenses

    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.size("base_starts").cast("long").alias("n_base"),
                        F.array_min("base_starts").alias("first_word"), F.array_max("base_starts").alias("last_word"),
                        "base_labels", "labels", "score")


@query("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items that documents hold, with the place and score of the best passage."""
    from optlake.llm.decontam import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark))


@query("op9_top_k")
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every hundredth vector."""
    from optlake.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), Scratch(spark))


#: A conversation whose texts hold control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


@query("op10_chat")
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, read back from the pieces, and of one made of control strings."""
    from optlake.llm.chat import events_of_turns, format_conversations, read_back

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"select -1L as conv_id, turn, role, '{CONTROL_TEXT}' as text "
                      "from values (0L, 'user'), (1L, 'assistant') as t(turn, role)")
    return read_back(format_conversations(events_of_turns(turns.unionByName(extra))))


@query("op11_jaccard_join")
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by five-word shingles."""
    from optlake.llm.jaccard import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"), Scratch(spark))


@query("op12_centroids")
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector."""
    from optlake.llm.centroids import cluster, with_inertia

    return with_inertia(cluster(table(spark, sf_dir, "embeddings"), Scratch(spark)))


@query("op13_resample")
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document; the target is the benchmark's distribution."""
    from optlake.llm.resample import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark))
