"""Registered queries of the training-data operators over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm import (
    decontaminate,
    lexical,
    lm_scoring,
    merkle,
    minmax,
    mixing,
    quality_rules,
    secrets,
    simhash,
    token_counts,
    toxicity,
    url_filter,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of all documents, by a model fitted on ``labels``."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by the base checks and a decision list learned from ``labels``."""
    docs = _table(spark, sf_dir, "documents")
    judged = quality_rules.judge(docs, quality_rules.fit_rules(docs, _table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "rule", "kept")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), limit=512)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to web archives and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("verified")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in all documents."""
    found, name = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", f"{name}.n_words", f"{name}.n_hit",
                        F.size(f"{name}.items").cast("long").alias("n_items"),
                        decontaminate.digest(F.col(f"{name}.items")).alias("items_sha256"),
                        (F.col(f"{name}.n_hit") > 0).alias("contaminated"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes, sources weighing 1, 2, 3 in turn."""
    return mixing.mix_plan(_table(spark, sf_dir, "documents"), weights=(1.0, 2.0, 3.0), cap=3.0)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 4-word shingles, at most 4 differing bits."""
    out = simhash.simhash_components(_table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of all documents under a network trained on all of them."""
    docs = _table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, lm_scoring.fit(docs))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, doc_id, host, bad) of the pages whose document is labelled.

    A page's document is the one whose number stands in the path of its url; it is bad if it is
    of low quality or toxic.  A url without a number gives no outcome.
    """
    known = labels.groupBy("doc_id").agg(F.max(F.greatest(1 - F.col("quality"), F.col("toxic"))).alias("bad"))
    number = F.regexp_extract(url_filter.path_of("url"), r"/([0-9]+)(?:[/.]|$)", 1).try_cast("long")
    held = pages.select("page_id", url_filter.host_of("url").alias("host"), number.alias("doc_id"))
    return held.join(known.filter("bad is not null"), "doc_id").select("page_id", "doc_id", "host", "bad")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or reputation verdict of all pages, learned from the labels of the documents they hold."""
    pages = _table(spark, sf_dir, "pages")
    outcomes = page_outcomes(pages, _table(spark, sf_dir, "labels"))
    return url_filter.judge_urls(pages, outcomes.select("host", "bad"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), top=50)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 2-word shingles, Jaccard similarity of 0.8 or more."""
    return minmax.minmax_components(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, every fifth (by CRC-32 of its id) tampered with."""
    return merkle.audit(_table(spark, sf_dir, "documents"), tampered={"text": merkle.lowered_every_fifth()})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_counts": op3_token_counts,
    "op4_warc": op4_warc,
    "op5_decontaminate": op5_decontaminate,
    "op6_mixing": op6_mixing,
    "op7_secrets": op7_secrets,
    "op8_simhash": op8_simhash,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_url_filter": op10_url_filter,
    "op11_ranked_search": op11_ranked_search,
    "op12_minhash": op12_minhash,
    "op13_merkle": op13_merkle,
}

_OP4_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), low AS (
  SELECT payload_digest, min(page_id) AS low FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN low.low IS NULL OR p.page_id = low.low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM low.low THEN low.low END AS refers_to
FROM p LEFT JOIN low USING (payload_digest)
"""

_OP5_SQL = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)
), hits AS (
  SELECT r, i, k, item_id FROM dw JOIN bw USING (k, win)
), marked AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r
), found AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN found USING (r)
"""

_TWO = ", ".join(f"'{s}'" for s in url_filter.TWO_LABEL_SUFFIXES)
_OP10_SQL = f"""
WITH u AS (
  SELECT page_id, TRY_CAST(regexp_extract(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '/([0-9]+)(?:[/.]|$)', 1) AS BIGINT)
           AS number, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), named AS (
  SELECT host, string_split(regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':[0-9]*$', ''), '.') AS l
  FROM (SELECT DISTINCT host FROM u)
), sfx AS (
  SELECT host, l, CASE WHEN array_to_string(l[-2:], '.') IN ({_TWO}) THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix
  FROM named
), dom AS (
  SELECT host, suffix, array_to_string(CASE WHEN contains(suffix, '.') THEN l[-3:] ELSE l[-2:] END, '.') AS domain FROM sfx
), lab AS (
  SELECT doc_id AS number, max(greatest(1 - quality, toxic)) AS bad FROM labels GROUP BY doc_id
), h0 AS (
  SELECT host, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM u JOIN lab USING (number) WHERE bad IS NOT NULL GROUP BY host
), h AS (SELECT * FROM h0 JOIN dom USING (host)),
a AS (SELECT coalesce(sum(bad), 0) + 1.0 AS al, coalesce(sum(n), 0) - coalesce(sum(bad), 0) + 1.0 AS be FROM h),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT al / (al + be) FROM a) AS m FROM h GROUP BY suffix),
sk AS ({{k_s}}),
sp AS (SELECT suffix, bad + k * m AS al, n - bad + k * (1 - m) AS be FROM s, sk),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(al / (al + be)) AS m
      FROM h JOIN sp USING (suffix) GROUP BY domain, suffix),
dk AS ({{k_d}}),
dp AS (SELECT domain, bad + k * m AS al, n - bad + k * (1 - m) AS be FROM d, dk),
g AS (SELECT host, n, bad, al / (al + be) AS m FROM h JOIN dp USING (domain)),
gk AS ({{k_g}}),
gp AS (SELECT host, bad + k * m AS al, n - bad + k * (1 - m) AS be FROM g, gk),
best AS (
  SELECT dom.host, coalesce(gp.al, dp.al, sp.al, (SELECT al FROM a)) AS al, coalesce(gp.be, dp.be, sp.be, (SELECT be FROM a)) AS be
  FROM dom LEFT JOIN gp USING (host) LEFT JOIN dp USING (domain) LEFT JOIN sp USING (suffix)
), bound AS (
  SELECT host, greatest(0.0, al / (al + be) - {url_filter.Z!r} * sqrt(al * be / ((al + be) * (al + be) * (al + be + 1)))) AS b
  FROM best
), ruled AS (
  SELECT page_id, host, path, {{rules}} AS rule FROM u
)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN round(b, 6) END AS bad_rate_bound,
       CASE WHEN rule IS NOT NULL THEN CASE rule {{verdicts}} END WHEN b > {url_filter.LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN bound USING (host)
"""


def _op10_sql() -> str:
    def k(level: str) -> str:
        rho = f"""(sum((bad - n * m) * (bad - n * m)) - sum(n * m * (1 - m))) / nullif(sum(n * m * (1 - m) * (n - 1)), 0)"""
        return (f"SELECT coalesce(greatest({url_filter.MIN_STRENGTH}, least({url_filter.MAX_STRENGTH}, "
                f"CASE WHEN rho > 0 THEN 1 / rho - 1 END)), {url_filter.DEFAULT_STRENGTH}) AS k FROM (SELECT {rho} AS rho FROM {level})")
    order = sorted(url_filter.RULES, key=lambda r: (-len(str(r)), str(r)))
    rules = "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r}'" for r in order) + " END"
    verdicts = " ".join(f"WHEN '{r}' THEN '{r.verdict}'" for r in order)
    return _OP10_SQL.format(k_s=k("s"), k_d=k("d"), k_g=k("g"), rules=rules, verdicts=verdicts)


_SPLIT = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_OP11_SQL = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '{_SPLIT}'), lambda x: x <> '') AS w
  FROM documents
), c AS (
  SELECT count(*) FILTER (len(w) > 0) AS big_n, sum(len(w))::BIGINT AS big_l FROM d
), q AS (
  SELECT DISTINCT item_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                               'abcdefghijklmnopqrstuvwxyz'), '{_SPLIT}')) AS t
  FROM benchmark
), p AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t
), f AS (
  SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS wt FROM p, c GROUP BY t, big_n
), s AS (
  SELECT item_id, r, sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * big_n) // big_l))))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN f USING (t) JOIN d USING (r), c WHERE t <> '' GROUP BY item_id, r
), o AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM s JOIN d USING (r) WHERE score > 0
)
SELECT * FROM o WHERE rank <= 50
"""

_OP12_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), e AS (
  SELECT doc_id, r, CASE WHEN len(w) < 2 THEN list_distinct(w)
                         ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM d
), x AS (
  SELECT r, len(s) AS n, unnest(s) AS g FROM e
), p AS (
  SELECT a.r AS u, b.r AS v FROM x a JOIN x b ON a.g = b.g AND a.r < b.r
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(r, o) AS (
  SELECT r, r FROM e
  UNION
  SELECT reach.r, l.v FROM reach JOIN (SELECT u, v FROM p UNION ALL SELECT v, u FROM p) l ON reach.o = l.u
), low AS (
  SELECT reach.r, min(e.doc_id) AS component_id FROM reach JOIN e ON reach.o = e.r GROUP BY reach.r
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM e JOIN low USING (r)
"""

_FOLD_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(d) + 1), lambda i: ascii(d[i])::BIGINT)),
    lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)),
                               lambda x, j: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _op13_sql(levels: int = 7) -> str:
    """Every level spelled out: ``levels`` of them hold 16 ** levels documents a source, and as many sources."""
    def enc(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(enc, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def climb(n: str, p: str, key: str) -> list[str]:
        """Levels over nodes ``n``0 and paths ``p``0 (row, key, idx, sib, fold)."""
        out = []
        for k in range(levels):
            out.append(f"""{n}r{k} AS (SELECT {key}, idx // 16 AS idx, any_value(n) AS n, list(digest ORDER BY idx) AS run
                FROM {n}{k} GROUP BY {key}, idx // 16)""")
            out.append(f"""{n}{k + 1} AS (SELECT {key}, idx, (n + 15) // 16 AS n,
                CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS digest FROM {n}r{k})""")
            left, right = "array_to_string(run[1:p.idx % 16], '')", "array_to_string(run[p.idx % 16 + 2:], '')"
            out.append(f"""{p}{k + 1} AS (SELECT p.* REPLACE (p.idx // 16 AS idx, sib || {left} || {right} AS sib,
                CASE WHEN r.n = 1 THEN fold ELSE sha256({left} || fold || {right}) END AS fold)
                FROM {p}{k} p JOIN {n}r{k} r ON p.{key} = r.{key} AND p.idx // 16 = r.idx)""")
        return out

    docs = f"""docs AS (
  SELECT *, {leaf("text")} AS leaf, {leaf("seen")} AS present, coalesce('=' || source, '') AS grp
  FROM (SELECT *, CASE WHEN crc % 5 = 0 THEN {_FOLD_AZ.format("text")} ELSE text END AS seen
        FROM (SELECT *, {_CRC32} AS crc FROM (SELECT *, doc_id::VARCHAR AS d FROM documents)))
), placed AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY grp) AS n FROM docs
), n0 AS (SELECT grp, idx, n, leaf AS digest FROM placed),
p0 AS (SELECT r, doc_id, leaf, grp, idx, '' AS sib, present AS fold FROM placed)"""
    upper = f"""u0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n, digest, grp FROM n{levels}),
q0 AS (SELECT p.r, p.doc_id, p.leaf, u0.digest AS subroot, u0.one, u0.idx, p.sib, p.fold FROM p{levels} p JOIN u0 USING (grp))"""
    return ("WITH " + ",\n".join([docs, *climb("n", "p", "grp"), upper, *climb("u", "q", "one")])
            + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(sib) AS proof_sha256, fold AS folded_root, fold = digest AS verified
FROM q{levels} JOIN u{levels} USING (one)""")


#: queries whose rows SQL can state; the others are tested against brute force
ORACLE_SQL: dict[str, str] = {"op4_warc": _OP4_SQL, "op5_decontaminate": _OP5_SQL, "op10_url_filter": _op10_sql(), "op11_ranked_search": _OP11_SQL, "op12_minhash": _OP12_SQL,
                              "op13_merkle": _op13_sql()}
