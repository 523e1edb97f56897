"""The numbered queries, each one operator with production parameters over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couponlens.llm import ann, chat, collocations, exact_dedup, lang_id, lexical, maxent, mixing, packing, pii, sharding, simhash, url_filter
from couponlens.llm.common import table


#: Shards of the placement query.
SHARDS = [f"shard-{i:03d}" for i in range(100)]
#: Stands for the key that a deployment keeps secret.
PII_KEY = b"replace this key in a deployment"


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time: page n was fetched n x 7919 seconds into the year 2024, going round."""
    return pages.select("page_id", "url", F.timestamp_seconds(1704067200 + F.col("page_id") * 7919 % 31536000).alias("fetched_at"))


def entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for the hosts of the pages, by rules on the host name.

    Spam and pill hosts are on list spam for good. Of the others, by length n
    and day n x 13 mod 300: n mod 3 = 0 puts the host on list hosts, takes it
    off after 45 days and puts it on again after 90; n mod 4 = 0 puts the
    host's path /en on list sections for 60 days; a blog host's parent
    domain is on list domains from day 200.
    """
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).where("host != ''").distinct()
    day = lambda d: F.timestamp_seconds(1704067200 + 86400 * d)
    n = F.length("host")
    start = n * 13 % 300
    entry = lambda name, key, action, d: F.struct(F.lit(name).alias("list"), key.alias("key"), F.lit(action).alias("action"), day(d).alias("dated"))
    host, path, parent = F.col("host"), F.concat("host", F.lit("/en")), F.regexp_replace("host", "^blog[.]", "")
    rules = F.concat(
        F.when(host.rlike("spam|pills"), F.array(entry("spam", host, "add", F.lit(0)))).otherwise(F.array()),
        F.when(n % 3 == 0, F.array(entry("hosts", host, "add", start), entry("hosts", host, "remove", start + 45),
                                   entry("hosts", host, "add", start + 90))).otherwise(F.array()),
        F.when(n % 4 == 0, F.array(entry("sections", path, "add", start), entry("sections", path, "remove", start + 60))).otherwise(F.array()),
        F.when(host.startswith("blog."), F.array(entry("domains", parent, "add", F.lit(200)))).otherwise(F.array()))
    return hosts.select(F.explode(rules).alias("e")).select("e.*")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_captures(captures(pages), entries(pages))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"), PII_KEY)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", "fingerprint", "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=1024).drop("__row")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest").drop("__row")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], sharding.shard_table(spark, SHARDS))
    return placed.select("doc_id", F.col("__slot").alias("slot"), F.col("__shard").alias("shard"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return chat.read_back(chat.format_conversations(rows.unionByName(planted)))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("__row")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lang_id.identify(docs, lang_id.learn_from_documents(docs))


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scores(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_pii_surrogates, op3_simhash_near_dedup, op4_packing, op5_exact_dedup, op6_sharding,
        op7_chat_formatting, op8_mixing, op9_nearest_neighbours, op10_language_id, op11_lm_scores, op12_lexical_search, op13_phrase_collocations)
}

ORACLE: dict[str, str] = {
    "op1_url_filter": r"""
        WITH captures AS (
            SELECT row_number() OVER () AS n, page_id, url, make_timestamp((1704067200 + page_id * 7919 % 31536000) * 1000000) AS fetched_at,
                   rtrim(regexp_extract(lower(trim(coalesce(url, ''))), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.') AS host,
                   list_filter(string_split(regexp_extract(trim(coalesce(url, '')), '(?i)^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') AS steps
            FROM pages),
        hosts AS (SELECT DISTINCT host, length(host) AS len, length(host) * 13 % 300 AS start FROM captures WHERE host <> ''),
        actions AS (
            SELECT 'spam' AS list, host AS key, 'add' AS action, 0 AS d FROM hosts WHERE regexp_matches(host, 'spam|pills')
            UNION SELECT 'hosts', host, 'add', start FROM hosts WHERE len % 3 = 0
            UNION SELECT 'hosts', host, 'remove', start + 45 FROM hosts WHERE len % 3 = 0
            UNION SELECT 'hosts', host, 'add', start + 90 FROM hosts WHERE len % 3 = 0
            UNION SELECT 'sections', host || '/en', 'add', start FROM hosts WHERE len % 4 = 0
            UNION SELECT 'sections', host || '/en', 'remove', start + 60 FROM hosts WHERE len % 4 = 0
            UNION SELECT 'domains', host[6:], 'add', 200 FROM hosts WHERE starts_with(host, 'blog.')),
        dated AS (SELECT list, key, action, make_timestamp((1704067200 + 86400 * d) * 1000000) AS since FROM actions),
        spans AS (SELECT *, lead(since) OVER (PARTITION BY list, key ORDER BY since, action) AS gone FROM dated),
        keys AS (
            SELECT n, fetched_at, array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') AS key
            FROM captures, unnest(range(1, len(string_split(host, '.')) + 1)) AS r(i) WHERE host <> ''
            UNION SELECT n, fetched_at, host || '/' || array_to_string(list_slice(steps, 1, i), '/')
            FROM captures, unnest(range(1, len(steps) + 1)) AS r(i) WHERE host <> ''),
        hits AS (SELECT keys.n, keys.key, list, since FROM keys JOIN spans ON keys.key = spans.key AND action = 'add'
                 AND fetched_at >= since AND (gone IS NULL OR fetched_at < gone)),
        best AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY length(key) DESC, key, list) AS r, count(*) OVER (PARTITION BY n) AS matches FROM hits)
        SELECT page_id, url, fetched_at, nullif(host, '') AS host, best.n IS NOT NULL AS blocked, list AS matched_list, key AS matched_key,
               since AS listed_since, coalesce(matches, 0) AS matches
        FROM captures LEFT JOIN best ON captures.n = best.n AND r = 1""",
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op7_chat_formatting": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) AS r(i)),
        written AS (SELECT *, replace(replace(replace(text, '\', '\\'), '<', '\l'), '#', '\h') AS body,
                           replace(replace(replace(replace(role, '\', '\\'), '<', '\l'), '#', '\h'), ':', '\c') AS head FROM rows)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length(head) + length(body) + length('<turn>### : </turn>') + 1) AS BIGINT) AS formatted_chars
        FROM written GROUP BY conv_id""",
    "op12_lexical_search": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
             t AS (SELECT r, unnest(terms) AS term FROM d),
             tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY ALL),
             df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
             s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM d WHERE len(terms) > 0),
             m AS (SELECT r, doc_id, 75 + (25 * len(terms) * n_docs) // all_terms AS m FROM d, s WHERE len(terms) > 0),
             i AS (SELECT row_number() OVER () AS q, item_id,
                   unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
             w AS (SELECT q, item_id, term, count(*) * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM i JOIN df USING (term), s GROUP BY q, item_id, term, n_docs, df),
             scored AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
                        FROM w JOIN tf USING (term) JOIN m USING (r) GROUP BY q, item_id, r, doc_id),
             ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""",
    "op13_phrase_collocations": r"""
        WITH docs AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
             pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
             lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
             starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
             grams AS (SELECT lang, list_slice(w, i, i + k) AS words FROM starts, range(5) AS r(k) WHERE i + k <= len(w)),
             f AS (SELECT lang, words, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
             sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
             longer AS (SELECT lang, unnest([list_slice(words, 1, len(words) - 1), list_slice(words, 2, len(words))]) AS words, f FROM f WHERE len(words) > 2),
             within AS (SELECT lang, words, max(f) AS f FROM longer GROUP BY ALL),
             kept AS (SELECT f.lang, f.words, f.f AS a FROM f LEFT JOIN within USING (lang, words) WHERE len(f.words) > 1 AND (within.f IS NULL OR within.f < f.f)),
             cuts AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM kept),
             scored AS (SELECT cuts.lang, cuts.words, a, k, x.f AS l, y.f AS r, n,
                               CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
                        FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.words = list_slice(cuts.words, 1, k)
                        JOIN f AS y ON y.lang = cuts.lang AND y.words = list_slice(cuts.words, k + 1, len(cuts.words)) JOIN sizes ON sizes.lang = cuts.lang),
             best AS (SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, k) AS c FROM scored),
             ranked AS (SELECT *, array_to_string(words, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank FROM best WHERE c = 1)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}
