"""The operators as named queries over the given tables, with independent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, embeddings, jaccard, licenses, lines, mixing, packing, periodic, quality, secrets, suffixes, urls
from .frames import SPACE_CLASS, read_table

Run = Callable[[SparkSession, str], DataFrame]


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        "kept_sha256")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.join(docs, likeness=jaccard.Likeness(width=3, part=90)).select(
        "doc_id", "n_shingles", F.col("class_id").alias("component_id"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(read_table(spark, sf_dir, "documents"))
    base = quality.passes(F.col("failures"), quality.BASE)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~base).alias("base_failed"),
        quality.passes(F.col("failures"), quality.CURRENT).alias("kept"), "n_lines", "failures")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT r, i, list_slice(ws, i, i + 2) AS win
      FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w WHERE len(ws) >= 3)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
rep AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
ls AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
       FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        coalesce(n_lines, 0)::BIGINT AS n_lines
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN ls USING (r)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_symbols > 20 * word_chars THEN 4 ELSE 0 END
        + CASE WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words
         AS base_failed, failures = 0 AS kept, n_lines, failures FROM f
"""

# The shares and the budget that the query mixes to.
MIX = mixing.Mix(flatten=(0.7, 0.7, 0.7), budget=0.9, repeats=True)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    rows = mixing.drawn(docs, MIX)
    return rows.select("doc_id", "source", "lang", "mixed.topic", "mixed.n_tokens", F.round("mixed.weight", 6).alias("weight"),
                       F.round("mixed.probability", 6).alias("probability"), "mixed.sampled",
                       F.round("mixed.expected", 6).alias("expected"), "mixed.copies")


def _mixing_sql(mix: mixing.Mix) -> str:
    """The same fit, one step for each dimension of each pass."""
    steps = ["""d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t, text FROM documents)""",
             r"""w AS (SELECT doc_id, source, lang, text, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
               CASE WHEN contains(t, ' | ') THEN 'table' WHEN regexp_matches(t, '@|https?://|\+\d') THEN 'contact'
                    WHEN contains(t, chr(10)) THEN 'paragraphs' ELSE 'prose' END AS topic FROM d)""",
             "c AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS n FROM w GROUP BY ALL)",
             "s AS (SELECT sum(n) AS total FROM c)"]
    for dim, power in zip(mixing.DIMENSIONS, mix.flatten, strict=True):
        steps.append(f"t_{dim} AS (SELECT {dim}, pow(sum(n)::DOUBLE, {power}) AS p FROM c GROUP BY {dim} HAVING sum(n) > 0)")
        steps.append(f"g_{dim} AS (SELECT {dim}, p / (SELECT sum(p) FROM t_{dim}) AS target FROM t_{dim})")
    steps.append("f0 AS (SELECT c.*, n / total::DOUBLE AS weight FROM c, s)")
    number = 0
    for _ in range(mix.passes):
        for dim in mixing.DIMENSIONS:
            steps.append(
                f"f{number + 1} AS (SELECT f.source, f.lang, f.topic, n, CASE WHEN sum(weight) OVER (PARTITION BY f.{dim}) > 0 "
                f"THEN weight * (coalesce(target, 0) / sum(weight) OVER (PARTITION BY f.{dim})) ELSE 0 END AS weight "
                f"FROM f{number} f LEFT JOIN g_{dim} g ON f.{dim} IS NOT DISTINCT FROM g.{dim})")
            number += 1
    steps.append(f"r AS MATERIALIZED (SELECT *, CASE WHEN n > 0 THEN weight / n ELSE 0 END AS rate FROM f{number})")
    steps.append(f"e AS MATERIALIZED (SELECT r.*, total, {mix.budget} * total * rate AS expected FROM r, s)")
    steps.append(f"""u AS (SELECT *, ('0x' || substr(md5('{mix.seed}' || chr(31) || doc_id || chr(31) || coalesce(text, chr(0))), 1, 8))
  ::BIGINT / 4294967296.0 AS draw FROM w)""")
    return "WITH " + ",\n".join(steps) + """
SELECT doc_id, u.source, u.lang, u.topic, n_tokens, round(CASE WHEN n > 0 THEN weight * total / n ELSE 0 END, 6) AS weight,
  round(least(1.0, expected), 6) AS probability, draw < expected AS sampled, round(expected, 6) AS expected,
  floor(expected)::BIGINT + (draw < expected - floor(expected))::BIGINT AS copies
FROM u JOIN e ON u.source IS NOT DISTINCT FROM e.source AND u.lang IS NOT DISTINCT FROM e.lang AND u.topic = e.topic"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.remove(docs, removed="n_removed").select("doc_id", "text", "n_removed")


OP5_SQL = rf"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM l),
b AS (SELECT k, min(doc_id) AS keeper FROM t WHERE k <> '' GROUP BY k HAVING least(count(DISTINCT source), count(DISTINCT text))
        >= CASE WHEN len(regexp_extract_all(k, '[^\x20\x09-\x0D]+')) >= {lines.Rule().words} THEN {lines.Rule().sites} ELSE {lines.Rule().short_sites} END),
r AS (SELECT t.*, b.k IS NOT NULL AND doc_id <> keeper AS gone FROM t LEFT JOIN b ON t.k = b.k),
a AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
        count(*) FILTER (gone) AS n_removed FROM r GROUP BY doc_id)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE a.text END AS text, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN a USING (doc_id)
"""


def op2_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    import public_tokenizers

    vocab = bpe.vocabulary(spark, public_tokenizers.path(vocabulary))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, vocab, public_tokenizers.PATTERN).select("doc_id", "tokens")
    return coded.select(
        "doc_id", "tokens.n_tokens", F.sha2("tokens.ids", 256).alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("tokens.ids"), vocab, public_tokenizers.PATTERN), 256).alias("decoded_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = "filter(secrets, s -> s.kind <> 'guess')"
    joined = "concat_ws(',', transform({}, s -> concat_ws(':', s.kind, s.start, s.end)))"
    count = "CAST(size(filter(secrets, s -> s.kind = '{}')) AS BIGINT)"
    return found.select(
        "doc_id", *[F.expr(count.format(k)).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.expr(f"sha2({joined.format(base)}, 256)").alias("base_sha256"), F.expr(joined.format("secrets")).alias("spans"))


# The rules that the query judges by.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, rules).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


OP9_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(regexp_extract(url, '://([^/?#]*)', 1), '') AS raw_host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
h AS (SELECT page_id, lower(raw_host) AS host, path FROM p),
r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS v(rh, rp, rv)),
w AS (SELECT page_id, host, path, rh || rp AS rule, rv,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST) AS k
      FROM h LEFT JOIN r ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM w WHERE k = 1
"""


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs).select("doc_id", "licences.*")
    label = F.create_map(*[F.lit(x) for pair in {**licenses.BASE_PHRASES, **licenses.PHRASES}.items() for x in pair])
    listed = ", ".join(f"'{p}'" for p in licenses.BASE_PHRASES)
    rows = found.select(
        "doc_id", "n_words", F.expr(f"filter(places, p -> p.phrase IN ({listed}))").alias("base"), "places", "expressions")
    labels_of = lambda places: F.transform(places, lambda p: label[p["phrase"]])
    tagged = F.flatten(F.transform("expressions", lambda e: e["identifiers"]))
    notices = F.array_distinct(labels_of(F.col("places")))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("base", lambda p: p["word"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels_of(F.col("base")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(notices, tagged))), ",").alias("labels"),
        # an identifier tag settles it; each further kind of notice halves the doubt
        F.when(F.size("expressions") > 0, F.lit(1.0)).otherwise(1.0 - F.pow(F.lit(0.5), F.size(notices))).alias("score"),
        F.transform("expressions", lambda e: e["expression"]).alias("expressions"),
        F.exists("expressions", lambda e: e["permitted"]).alias("permitted"))


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """The rows as the query damages them; dropped ones stay with ``present`` false and only name their conversation."""
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    kind = F.col("kind")
    return rows.select("*", (F.crc32(place.cast("binary")) % 20).alias("kind")).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy")
    ).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged_conversations(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return conversations.reports(rows, present=F.col("present"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents as the query changes them: of every tenth, by a hash of the id, the words from some place on repeat."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) div 10")
    split = F.filter(F.split(F.col("text"), SPACE_CLASS + "+"), lambda w: w != "")
    # a lambda over one value binds it, so that nothing is computed once for each word
    bound = lambda value, then: F.transform(F.array(value), then)[0]

    def repeated(words: Column) -> Column:
        source = lambda i, m: F.when(i < m["a"], i).otherwise(m["a"] + (i - m["a"]) % m["p"]).cast("int")
        start = g % F.size(words)
        marks = F.struct(start.alias("a"), (1 + F.floor((F.size(words) - start) / (3 + g % 8))).alias("p"))
        tail = bound(marks, lambda m: F.transform(words, lambda _, i: F.get(words, source(i, m))))
        return F.when(F.size(words) > 0, F.array_join(tail, " ")).otherwise("")

    text = F.when(h % 10 == 0, bound(split, repeated)).otherwise(F.col("text"))
    # through a generator: the optimizer would move the lambdas into the call of a Python function, where they cannot run
    return docs.select(*[c for c in docs.columns if c != "text"], F.explode(F.array(text)).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.runs(docs).select("doc_id", "periodic.*")
    stronger = lambda r, best: (r["length"] * best["period"]) > (best["length"] * r["period"])
    # runs come by start, then period, so a tie stays with the first
    best = F.when(F.size("runs") > 0, F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
        lambda best, r: F.when(stronger(r, best), r).otherwise(best)))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    rows = found.select("doc_id", "runs", "collapsed", "n_words", best.alias("best"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")


def op13_packing(spark: SparkSession, sf_dir: str, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    vocab = packing.vocabulary(spark, public_tokenizers.path(vocabulary))
    pieces = packing.pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocab, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "padded_to")


QUERIES: dict[str, Run] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secret_scan": op3_secret_scan,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filter": op9_url_filter,
    "op10_license_scan": op10_license_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_packing": op13_packing,
}
SQL: dict[str, str] = {
    "op1_source_mixing": _mixing_sql(MIX),
    "op5_line_dedup": OP5_SQL,
    "op8_quality_rules": OP8_SQL,
    "op9_url_filter": OP9_SQL,
}
