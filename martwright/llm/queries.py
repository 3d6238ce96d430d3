"""The operators as queries over the driver's tables: whole tables, production parameters, the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martwright.llm import (
    bpe,
    decontaminate,
    filter_audit,
    html_extract,
    language_id,
    nn_descent,
    periodic_runs,
    pii,
    quality_classifier,
    quality_rules,
    simhash,
    substring_dedup,
    toxicity,
)
from martwright.llm.store import stored

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def held_out(modulus: int, rest: int) -> Column:
    """False for a null id, which no label has either."""
    return F.coalesce(remainder(modulus) == rest, F.lit(False))


def scored(scores: DataFrame, modulus: int, rest: int) -> DataFrame:
    return scores.select(
        "doc_id", held_out(modulus, rest).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, remainder(5) != 0)
    return scored(toxicity.toxicity(docs, model), 5, 0)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels, remainder(3) != 1)
    return scored(quality_classifier.quality(docs, model), 3, 1)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.language(docs, language_id.fit(docs, remainder(4) != 2))
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(pii.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.main_texts(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = stored(decontaminate.positional_index(table(spark, sf_dir, "documents")))
    found = decontaminate.contamination(index, table(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality_rules.quality_rules(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"
    )


def public_tokenizer(name: str = "byte_bpe_multi_50k.tiktoken") -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(public_tokenizers.path(name), public_tokenizers.PATTERN)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizer()
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the words of one document in ten, by a hash of its id, repeat from some word on.

    With h = crc32 of the id as text, g = h div 10 and n words, the document is chosen if h is a multiple of 10; its words
    from a = g mod n on are those of one period of 1 + (n - a) div (3 + g mod 8) words. Others, null ids too, stay as they are.
    """
    h = F.crc32(docs["doc_id"].cast("string"))
    text = docs["text"].cast("string")
    split = docs.select(
        docs["doc_id"].alias("doc_id"), text.alias("text"), F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, filter_audit.words(text)).alias("words"),
    )
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    sized = split.select("doc_id", "text", "words", "g", n.alias("n"), F.when(n > 0, a).alias("a"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    left = F.col("n") - F.col("a")
    repeats = F.ceil(left / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), repeats))
    repeated = F.concat_ws(" ", F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), left)))
    return sized.withColumn("p", period).select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_repeated_tails(table(spark, sf_dir, "documents")))
    longest = found.withColumn("longest", periodic_runs.longest("runs"))
    line = lambda x: F.concat(x["start"], F.lit(","), x["length"], F.lit(","), x["period"], F.lit("\n"))
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language_id": op3_language_id,
    "op4_pii": op4_pii,
    "op5_html_extraction": op5_html_extraction,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_quality_rules": op8_quality_rules,
    "op9_bpe": op9_bpe,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_nn_descent": op11_nn_descent,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Queries that DuckDB can express.
ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": """
        with d as (
            select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as w from documents
        ), win as (
            select doc_id, p, sha256(array_to_string(w[p : p + 49], ' ')) as h
            from (select doc_id, w, unnest(range(1, len(w) - 48)) as p from d where len(w) >= 50)
        ), smallest as (
            select h, min(doc_id) as first_doc from win group by h
        ), gone as (
            select distinct doc_id, unnest(range(p, p + 50)) as q
            from win join smallest using (h) where first_doc < doc_id
        ), words as (
            select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as q from d
        ), rest as (
            select doc_id, string_agg(word, ' ' order by q) as kept, count(*) as n_kept
            from words anti join gone using (doc_id, q) group by doc_id
        )
        select doc_id, len(w)::bigint as n_words, len(w)::bigint - coalesce(n_kept, 0) as n_removed,
               sha256(coalesce(kept, '')) as kept_sha256
        from d left join rest using (doc_id)
    """,
    "op6_decontamination": f"""
        with d as (
            select doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
            from documents
        ), i as (
            select item_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
            from benchmark
        ), iw as (
            select distinct item_id, least(10, len(w)) as n,
                   array_to_string(w[p : p + least(10, len(w)) - 1], ' ') as win
            from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as p from i where len(w) > 0)
        ), sizes as (
            select distinct n from iw
        ), dw as (
            select doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') as win
            from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p from d, sizes where len(w) >= n)
        ), m as (
            select doc_id, p, dw.n, item_id from dw join iw on dw.win = iw.win and dw.n = iw.n
        ), h as (
            select doc_id, count(distinct q) as n_hit
            from (select doc_id, unnest(range(p, p + n)) as q from m) group by doc_id
        ), s as (
            select doc_id, count(*) as n_items, sha256(string_agg(id, ',' order by id)) as items_sha256
            from (select distinct doc_id, item_id::varchar as id from m) group by doc_id
        )
        select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
               coalesce(n_items, 0)::bigint as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from d left join h using (doc_id) left join s using (doc_id)
    """,
    "op12_filter_audit": """
        with d as (
            select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
                   coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as w
            from documents
        ), known as (
            select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
        ), f as (
            select part, (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
                   + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t))::int
                   + 8 * regexp_matches(t, '[#$%&*|]')::int
                   + 16 * coalesce(d.doc_id > min(d.doc_id) over (partition by t), false)::int as mask,
                   coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
            from d left join known on d.doc_id = known.doc_id
        ), counts as (
            select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, mask
        ), letters as (
            select substr('ABCDE', i, 1) as x, 1 << (i - 1) as bit from (select unnest(range(1, 6))::int as i)
        ), orders as (
            select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
            from letters a, letters b, letters c, letters d, letters e
            where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), steps as (
            select filter_order, step, bits[step] as own, coalesce(list_sum(bits[1 : step - 1]), 0)::int as before
            from orders, (select unnest(range(1, 6))::int as step)
        ), fate as (
            select part, filter_order, step, substr(filter_order, step, 1) as filter,
                   sum(case when mask & (before + own) = 0 then n else 0 end) as kept,
                   sum(case when mask & before = 0 and mask & own <> 0 then n else 0 end) as removed,
                   sum(case when mask & before <> 0 and mask & own <> 0 then n else 0 end) as redundant,
                   sum(case when mask = own then n else 0 end) as unique_fails,
                   sum(case when mask & before = 0 and mask & own <> 0 then good else 0 end) as good_lost,
                   sum(case when mask & before = 0 and mask & own <> 0 then toxic else 0 end) as toxic_lost
            from counts, steps group by part, filter_order, step
        )
        select part, filter_order, step, filter, kept::bigint as kept, removed::bigint as removed,
               redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
               toxic_lost::bigint as toxic_lost,
               (sum(removed) over (partition by part, filter))::bigint as shapley
        from fate
    """,
}
