"""DuckDB SQL for the queries that SQL can express: exact versions of what the operators compute."""

from __future__ import annotations

from barflow.llm import embed_dedup, jaccard, lexical_search, url_filter

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_UPPER.lower()}')"


# Smallest id reachable over links(a, b), for every row of nodes(id).
_COMPONENTS = """reach(id, other) AS (
        SELECT id, id FROM nodes
        UNION
        SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
    low AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""


def jaccard_sql() -> str:
    """All pairs that share a shingle, by exact counts."""
    k, percent = jaccard.SIZE, jaccard.PERCENT
    return rf"""WITH RECURSIVE w AS (
        SELECT doc_id AS id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS words FROM documents),
    s AS (SELECT id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(words) - {k - 1}, 1) + 1),
            lambda i: array_to_string(words[i:i + {k - 1}], ' '))) END AS shingles FROM w),
    sized AS (SELECT id, len(shingles) AS n FROM s),
    e AS (SELECT id, hash(unnest(shingles)) AS shingle FROM s),
    common AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM e x JOIN e y ON x.shingle = y.shingle AND x.id < y.id GROUP BY x.id, y.id),
    pairs AS (SELECT a, b FROM common JOIN sized p ON p.id = a JOIN sized q ON q.id = b WHERE 100 * c >= {percent} * (p.n + q.n - c)),
    links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
    nodes AS (SELECT id FROM s), {_COMPONENTS}
    SELECT id AS doc_id, CAST(n AS BIGINT) AS n_shingles, component_id FROM sized JOIN low USING (id)"""


def embeddings_sql() -> str:
    """All pairs, by the cosine in double precision."""
    return f"""WITH RECURSIVE v AS (
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    ok AS (SELECT id, x, sqrt(list_dot_product(x, x)) AS norm FROM v
           WHERE x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
    links AS (SELECT p.id AS a, q.id AS b FROM ok p JOIN ok q ON p.id <> q.id AND len(p.x) = len(q.x)
              WHERE list_dot_product(p.x, q.x) / (p.norm * q.norm) >= {embed_dedup.LEAST_COSINE}),
    nodes AS (SELECT id FROM v), {_COMPONENTS}
    SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept FROM low"""


def urls_sql() -> str:
    """The rules, and both Markov models by one join an order."""
    order, symbols, fold, width = url_filter.ORDER, url_filter.SYMBOLS, url_filter.CALIBRATE, url_filter.BIN
    rules = sorted(url_filter.RULES, key=lambda r: (-len(r[1]), r[1]))

    def case(value) -> str:
        tests = []
        for verdict, rule in rules:
            host, slash, rest = rule.partition("/")
            tests.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + rest}') THEN '{value(verdict, rule)}'")
        return f"CASE {' '.join(tests)} END"

    levels, prior = [], ""
    for k in range(1, order + 1):
        base = {c: "b.p_" + c if k > 1 else f"CAST({1.0 / symbols!r} AS DOUBLE)" for c in "ar"}
        p = {c: f"CASE WHEN n_{c} > 0 THEN ({c} + t_{c} * {base[c]}) / (n_{c} + t_{c}) ELSE {base[c]} END AS p_{c}" for c in "ar"}
        join = f"JOIN p{k - 1} b ON b.gram = right(g.gram, {k - 1})" if k > 1 else ""
        levels.append(f"p{k} AS (SELECT g.gram, {p['a']}, {p['r']} FROM counted g {join} WHERE length(g.gram) = {k})")
        prior = " UNION ALL ".join(f"SELECT * FROM p{j}" for j in range(1, k + 1))
    sums = ", ".join(f"sum({c}) OVER c AS n_{c}, sum(CASE WHEN {c} > 0 THEN 1 ELSE 0 END) OVER c AS t_{c}" for c in "ar")
    return rf"""WITH cut AS (SELECT page_id, url, count(*) AS copies, {_lower("regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1)")} AS host,
            regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) AS path FROM pages GROUP BY page_id, url),
    judged AS (SELECT *, {case(lambda v, r: r)} AS rule, {case(lambda v, r: v)} AS decided,
            '^' || regexp_replace(regexp_replace({_lower('host || path')}, '[0-9]', '0', 'g'), '[^a-z0./-]', '~', 'gs') || '$' AS marks FROM cut),
    u AS (SELECT *, row_number() OVER () AS id, decided IS NOT NULL AND CAST('0x' || substr(md5(marks), 1, 8) AS BIGINT) % {fold} = 0 AS calibrates FROM judged),
    ends AS (SELECT id, unnest(list_transform(range(2, length(marks) + 1),
            lambda i: substr(marks, greatest(i - {order - 1}, 1), least(i, {order})))) AS gram FROM u),
    full_counts AS (SELECT gram, sum(CASE WHEN decided = 'allow' AND NOT calibrates THEN 1 ELSE 0 END) AS a,
            sum(CASE WHEN decided = 'block' AND NOT calibrates THEN 1 ELSE 0 END) AS r FROM ends JOIN u USING (id) GROUP BY gram),
    parts AS (SELECT a, r, unnest(list_transform(range(1, length(gram) + 1), lambda k: right(gram, k))) AS gram FROM full_counts),
    grams AS (SELECT gram, sum(a) AS a, sum(r) AS r FROM parts GROUP BY gram),
    counted AS (SELECT gram, a, r, {sums} FROM grams WINDOW c AS (PARTITION BY left(gram, length(gram) - 1), length(gram))),
    {', '.join(levels)},
    every AS ({prior}),
    scored AS (SELECT id, sum(ln(p_a) - ln(p_r)) / count(*) AS score FROM ends JOIN every USING (gram) GROUP BY id),
    bins AS (SELECT greatest(-2000, least(2000, floor(score / {width}))) AS bin, sum(CASE WHEN decided = 'allow' THEN copies ELSE 0 END) AS a,
            sum(CASE WHEN decided = 'block' THEN copies ELSE 0 END) AS r FROM u JOIN scored USING (id) WHERE calibrates GROUP BY 1),
    errors AS (SELECT bin, coalesce(sum(a) OVER below, 0) / nullif(sum(a) OVER (), 0) + 1 - coalesce(sum(r) OVER below, 0) / nullif(sum(r) OVER (), 0) AS error
            FROM bins WINDOW below AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    best AS (SELECT bin * {width} AS edge FROM errors WHERE error IS NOT NULL ORDER BY error, abs(bin) LIMIT 1)
    SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN score >= coalesce((SELECT edge FROM best), CAST('-inf' AS DOUBLE)) THEN 'allow' ELSE 'block' END) AS verdict
    FROM u JOIN scored USING (id), range(1, copies + 1)"""


def search_sql() -> str:
    """Every document's score for every item, by one join on terms."""
    terms = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def words(table: str, key: str) -> str:
        return f"SELECT {key} AS id, row_number() OVER () AS r, unnest(regexp_extract_all({_lower('text')}, '{terms}')) AS term FROM {table}"

    return f"""WITH d AS ({words("documents", "doc_id")}), q AS (SELECT DISTINCT * FROM ({words("benchmark", "item_id")})),
    size AS (SELECT r, count(*) AS n FROM d GROUP BY r), whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM size),
    tf AS (SELECT r, id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY r, id, term),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, docs),
    v AS (SELECT r, id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // l))) AS v FROM tf JOIN w USING (term) JOIN size USING (r), whole),
    scores AS (SELECT q.r AS item, q.id AS item_id, v.r, v.id AS doc_id, sum(v)::BIGINT AS score FROM q JOIN v USING (term) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scores WHERE score > 0)
    SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM ranked WHERE place <= {lexical_search.K}"""


ORACLE_SQL = {"op5_jaccard": jaccard_sql(), "op8_urls": urls_sql(), "op9_embeddings": embeddings_sql(),
              "op13_search": search_sql()}
