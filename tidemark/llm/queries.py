"""Registered queries of the corpus operators, over whole tables and whole texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import contamination, fingerprints, html_text, jaccard, languages, licenses, packing, phrases, pii, runs, substrings, toxicity, url_filter
from tidemark.llm.common import TOKEN, fold, read, sha256_hex


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fingerprints.with_next(read(spark, sf_dir, "documents"))
    n, text = F.length("text"), F.col("text")
    taken = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr(text, F.lit(1), n - taken), F.substr(F.col("next_text"), F.lit(1), taken))
    sketches = ("own", "own_cells", "next", "next_cells")
    texts = docs.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), *sketches)
    sets = texts.select(
        "doc_id",
        "n_chars",
        sha256_hex(F.col("edited")).alias("edited_sha256"),
        fingerprints.digests(F.col("edited")).alias("new"),
        *sketches,
    )
    cells = sets.select("*", fingerprints.sketch(F.col("new")).alias("new_cells"))

    def compared(other: str) -> Column:
        return fingerprints.difference(F.col("own"), F.col(other), F.col("own_cells"), F.col(f"{other}_cells"))

    found = cells.select("*", compared("new").alias("to_new"), compared("next").alias("to_next"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.encoded(F.col("own"), F.col("own_cells")).alias("fingerprint"),
        fingerprints.encoded(F.col("new"), F.col("new_cells")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("own"), F.col("new"), F.col("to_new")).alias("near_edited"),
        fingerprints.likeness(F.col("own"), F.col("next"), F.col("to_next")).alias("near_next"),
        (F.col("to_new.whole") & F.col("to_next.whole")).alias("recovered"),
    )


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.with_main_text(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op3_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = languages.fit(docs.where(fold(F.col("doc_id"), 4) != 2))
    out = languages.with_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "languages")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.with_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    x = F.col("licenses")
    return found.select(
        "doc_id",
        x["n_words"].alias("n_words"),
        F.size(x["places"]).cast("bigint").alias("n_base"),
        F.array_min(x["places"]).alias("first_word"),
        F.array_max(x["places"]).alias("last_word"),
        F.array_join(x["base_labels"], ",").alias("base_labels"),
        F.array_join(x["labels"], ",").alias("labels"),
        x["score"].alias("score"),
        F.array_join(x["expressions"], "; ").alias("expressions"),
        x["permissive"].alias("permissive"),
    )


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "documents").select("doc_id", pii.spans(F.col("text")).alias("found"))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in ("email", "ip", "card", "phone")],
        sha256_hex(pii.described(F.col("found"), base=True)).alias("base_sha256"),
        pii.described(F.col("found")).alias("spans"),
        F.size("found").cast("bigint").alias("n_spans"),
    )


def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.size(contamination.hit_words(F.col("hits"))).cast("bigint")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


OP6_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), bw AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (
    SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win
), covered AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.classes(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", jaccard.component_id(F.col("component")).alias("component_id"), "n_links")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs.where(~held_out), labels)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.deduplicate(read(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("kept", "kept_sha256")


OP9_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS win
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), first AS (
    SELECT win, min(doc_id) AS lo FROM win GROUP BY win HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (win) WHERE doc_id > lo
), kept AS (
    SELECT d.r, string_agg(x.w, ' ' ORDER BY x.p) AS txt
    FROM (SELECT r, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS p FROM d) x JOIN d USING (r) ANTI JOIN gone USING (r, p)
    GROUP BY d.r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT r, count(*) AS n FROM gone GROUP BY r) USING (r) LEFT JOIN kept USING (r)
"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


#: Fixed by the contract; where they decide, they are also what the trees learn from.
URL_RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, rules = read(spark, sf_dir, "pages").select("page_id", "url"), url_filter.parse_rules(URL_RULES)
    model = url_filter.fit(url_filter.label_by_rules(pages, rules))
    return url_filter.judge(pages, rules, model).select("page_id", "host", "path", "rule", "verdict", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(read(spark, sf_dir, "documents").select("lang", "text"))
    return found.withColumnRenamed("name", "lang")


OP12_SQL = r"""
WITH piece AS (
    SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    )
), total AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang
), gram AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, range(1, 5) t(k) WHERE len(w) >= k)
), f AS (
    SELECT lang, phrase, any_value(k) AS k, string_split(any_value(phrase), ' ') AS w, count(*) AS f
    FROM gram GROUP BY lang, phrase HAVING count(*) >= 30
), cut AS (
    SELECT lang, phrase, w, f AS a, c, array_to_string(w[1:c], ' ') AS lp, array_to_string(w[c + 1:], ' ') AS rp
    FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)
), scored AS (
    SELECT cut.lang, cut.phrase, a, c, x.f AS l, y.f AS r,
           CAST(2000000::HUGEINT * a // (x.f::HUGEINT + y.f::HUGEINT) AS BIGINT) AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inner_part AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS f
    FROM (
        SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT lang, w, f, k, unnest(range(2, k)) AS m FROM f WHERE k > 2)
    )
    GROUP BY ALL
), kept AS (
    SELECT best.* FROM best LEFT JOIN inner_part i USING (lang, phrase)
    WHERE i.f IS NULL OR 100::HUGEINT * i.f < 80::HUGEINT * best.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""


def _repeating(docs: DataFrame) -> DataFrame:
    """The contract's input: in every tenth document the words from a place on repeat some of its own words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({TOKEN})"), F.lit(1)))
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    g, n = F.col("g"), F.size("words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    placed = split.select("doc_id", "text", "words", F.when(n > 0, a).alias("a"), F.when(n > 0, p).alias("p"))
    source = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    )
    text = F.array_join(F.transform(source, lambda i: F.element_at("words", i + 1)), " ")
    return placed.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _repeating(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.with_runs(docs).select("doc_id", "periodic.*")
    order = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    first = F.array_min(order)  # the longest, ties by start and period
    length, period = -first["col1"], first["period"]
    described = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        first["start"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        sha256_hex(F.concat(F.array_join(described, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))).alias("runs_sha256"),
        sha256_hex(F.col("collapsed")).alias("collapsed_sha256"),
    )


#: The recursive parts compute crc32 of the decimal doc_id, which DuckDB lacks, from its byte table.
OP13_SQL = r"""
WITH RECURSIVE shifted AS (
    SELECT CAST(range AS BIGINT) AS byte, CAST(range AS BIGINT) AS v, 0 AS k FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM shifted WHERE k < 8
), crc_table AS (
    SELECT byte, v FROM shifted WHERE k = 8
), crc AS (
    SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS id, 0 AS k, CAST(4294967295 AS BIGINT) AS v
    FROM (SELECT DISTINCT doc_id FROM documents)
    UNION ALL
    SELECT doc_id, id, crc.k + 1, xor(crc.v >> 8, t.v)
    FROM crc JOIN crc_table t ON t.byte = xor(crc.v, ascii(substr(id, crc.k + 1, 1))) & 255
    WHERE crc.k < length(id)
), hashed AS (
    SELECT doc_id, xor(v, 4294967295) AS h, xor(v, 4294967295) // 10 AS g FROM crc WHERE k = length(id)
), split AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
), planted AS (
    SELECT r, s.doc_id, w, len(w) AS n, h, g, CASE WHEN len(w) > 0 THEN g % len(w) END AS a
    FROM split s JOIN hashed USING (doc_id)
), d AS (
    SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN [w[CASE WHEN i < a THEN i + 1 ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1 END] FOR i IN range(0, n)]
        ELSE w END AS w
    FROM planted
), pos AS (
    SELECT r, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM d
), same AS (
    SELECT x.r, x.i, y.i - x.i AS q FROM pos x JOIN pos y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretch AS (
    SELECT r, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same)
    GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), run AS (
    SELECT r, start, length, q FROM stretch t
    WHERE NOT EXISTS (
        SELECT 1 FROM stretch u WHERE u.r = t.r AND u.q < t.q AND u.start <= t.start AND u.start + u.length >= t.start + t.length
    )
), described AS (
    SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS runs,
           first(struct_pack(s := start, l := length, p := q) ORDER BY length DESC, start, q) AS top
    FROM run GROUP BY r
), gone AS (
    SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM run
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS txt FROM pos ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(top.l AS BIGINT) AS length,
       CAST(top.p AS BIGINT) AS period, CAST(1000 * top.l // top.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(txt, '')) AS collapsed_sha256
FROM d LEFT JOIN described USING (r) LEFT JOIN kept USING (r)
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_main_text, op3_languages, op4_licenses, op5_personal_data, op6_contamination, op7_jaccard,
        op8_toxicity, op9_substrings, op10_packing, op11_url_filter, op12_collocations, op13_periodic_runs,
    )
}
SQL: dict[str, str] = {"op6_contamination": OP6_SQL, "op9_substrings": OP9_SQL, "op12_collocations": OP12_SQL, "op13_periodic_runs": OP13_SQL}
