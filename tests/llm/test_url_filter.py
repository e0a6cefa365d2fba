import hashlib
import math
import re
from collections import Counter, defaultdict

from barflow.llm import queries
from barflow.llm import url_filter as U

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans(U.LETTERS.upper(), U.LETTERS)


def split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def rule_of(host, path):
    best = None
    for verdict, rule in U.RULES:
        h, _, rest = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best or (None, None)


def marks(host, path):
    return "^" + re.sub("[^a-z0./-]", "~", re.sub("[0-9]", "0", (host + path).translate(LOWER))) + "$"


def brute(pages):
    """Verdicts by a direct computation of both models."""
    rows = []
    for page, url in pages:
        host, path = split(url)
        verdict, rule = rule_of(host, path)
        rows.append((page, host, path, rule, verdict, marks(host, path), url))
    distinct = {(r[0], r[6]): r for r in rows}
    copies = Counter((r[0], r[6]) for r in rows)
    counts = {v: Counter() for v in ("allow", "block")}
    calibrate = lambda m: int(hashlib.md5(m.encode()).hexdigest()[:8], 16) % U.CALIBRATE == 0
    grams = lambda m: [m[max(0, i - U.ORDER + 1):i + 1] for i in range(1, len(m))]
    for r in distinct.values():
        if r[4] and not calibrate(r[5]):
            for g in grams(r[5]):
                for k in range(1, len(g) + 1):
                    counts[r[4]][g[-k:]] += 1
    follow = {v: defaultdict(list) for v in counts}
    for v, c in counts.items():
        for g, n in c.items():
            follow[v][g[:-1]].append(n)

    def p(v, g):
        base = p(v, g[1:]) if len(g) > 1 else 1 / U.SYMBOLS
        after = follow[v].get(g[:-1])
        return (counts[v][g] + len(after) * base) / (sum(after) + len(after)) if after else base

    score = {k: sum(math.log(p("allow", g)) - math.log(p("block", g)) for g in grams(r[5])) / (len(r[5]) - 1) for k, r in distinct.items()}
    held = [(math.floor(score[k] / U.BIN), r[4], copies[k]) for k, r in distinct.items() if r[4] and calibrate(r[5])]
    total = {v: sum(n for _, w, n in held if w == v) for v in counts}
    at = None
    if all(total.values()):
        error = lambda b: (sum(n for x, v, n in held if v == "allow" and x < b) / total["allow"]
                           + 1 - sum(n for x, v, n in held if v == "block" and x < b) / total["block"])
        at = min({x for x, _, _ in held}, key=lambda b: (error(b), abs(b))) * U.BIN
    guess = lambda k: "allow" if at is None or score[k] >= at else "block"
    return sorted(((r[0], r[1], r[2], r[3], r[4] or guess((r[0], r[6]))) for r in rows), key=str)


def spark_rows(pages):
    return sorted((tuple(r) for r in U.judge_urls(pages).drop("score").collect()), key=str)


def test_table_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = brute([(r["page_id"], r["url"]) for r in pages.collect()])
    assert spark_rows(pages) == want
    assert sorted((tuple(r) for r in queries.op8_urls(spark, SF).collect()), key=str) == want


def test_edge_cases(spark):
    urls = ["http://A.COM/x", "http://a.com", "https://www.example.com/en/1", "http://example.com/en", "http://b.net/es/?q=/fr/", "ftp://c.net/fr/#x",
            "no scheme/", None, "", "x://", "http://notexample.com/en/é", "http://ünï.org/p", "http://d.org/" + "a1" * 30000, "y://a.com/x://b.net/es/",
            "http://A.COM/x", "http://x.net:80/es/", "http://example.com/en/2?x", "http://m.example.com/en/3"]
    rows = [(k if k != 3 else None, u, "row", "rule") for k, u in enumerate(urls)] + [(0, urls[0], "row", "rule")]
    pages = spark.createDataFrame(rows, "page_id long, url string, row string, rule string")
    assert spark_rows(pages) == brute([(r[0], r[1]) for r in rows])
    assert U.judge_urls(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in U.judge_urls(pages.where("page_id in (6, 11)")).collect()} == {"allow"}
