"""URL filter: host and path rules, then a weighted vocabulary of terms found by
an Aho-Corasick automaton.

A term counts only between boundaries (no letter or digit next to it). One
strict term rejects; so do soft terms whose weights, each distinct term once,
reach `SOFT_LIMIT`.

Cases: a null url or one without `://` has empty host and path, no rule and no
terms are looked up in a null; upper case counts as lower case; a term that is
part of a longer hit counts by its own boundaries; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
STRICT = ("porn", "xxx", "hentai", "camgirls", "escorts", "malware", "phishing", "warez", "keygen", "darkmarket")
SOFT = {
    "sex": 1.0,
    "nude": 1.0,
    "adult": 0.5,
    "dating": 0.5,
    "casino": 1.0,
    "poker": 0.5,
    "betting": 0.5,
    "jackpot": 0.5,
    "pills": 1.0,
    "viagra": 1.0,
    "torrent": 0.5,
    "crack": 0.5,
    "serial": 0.5,
    "payday": 0.5,
    "clickbait": 1.0,
}
SOFT_LIMIT = 1.5


def _rule(host: str, path: str, rules: tuple) -> tuple[str, str] | None:
    fits = [
        (h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits, key=lambda x: len(x[0])) if fits else None


def _term_hits(url: str, automaton: ahocorasick.Automaton | None) -> set[str]:
    if automaton is None:
        return set()
    word = lambda i: 0 <= i < len(url) and (url[i] in SMALL or url[i] in "0123456789")
    return {t for end, t in automaton.iter(url) if not word(end + 1) and not word(end - len(t))}


def judge_urls(
    pages: DataFrame,
    rules: tuple = RULES,
    strict: tuple[str, ...] = STRICT,
    soft: dict[str, float] | None = None,
    soft_limit: float = SOFT_LIMIT,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_weight."""
    soft = SOFT if soft is None else soft

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for term in {*strict, *soft}:
            automaton.add_word(term, term)
        if len(automaton):
            automaton.make_automaton()
        else:
            automaton = None
        for batch in batches:
            rules_of, verdicts, strict_n, weights = [], [], [], []
            for host, path, url in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)]):
                hits = _term_hits(url, automaton)
                n, weight = len(hits & {*strict}), sum(soft[t] for t in sorted(hits) if t in soft)
                found = _rule(host, path, rules)
                rules_of.append(found[0] if found else None)
                verdicts.append(found[1] if found else "block" if n or weight >= soft_limit else "allow")
                strict_n.append(n)
                weights.append(float(weight))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(rules_of, pa.string()),
                    pa.array(verdicts, pa.string()),
                    pa.array(strict_n, pa.int32()),
                    pa.array(weights, pa.float64()),
                ],
                ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_weight"],
            )

    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    parsed = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.translate(host, UPPER, SMALL).alias("host"),
        path.alias("path"),
        F.translate(url, UPPER, SMALL).alias("url"),
    )
    return parsed.mapInArrow(
        run,
        "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_weight double",
    )


def url_sql() -> str:
    """The same judgement for DuckDB, with the rules and terms written out."""
    low = lambda x: f"translate({x}, '{UPPER}', '{SMALL}')"
    hit = lambda t: f"CASE WHEN regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') THEN "
    strict_n = " + ".join(hit(t) + "1 ELSE 0 END" for t in STRICT)
    weight = " + ".join(hit(t) + f"{w}::DOUBLE ELSE 0 END" for t, w in SOFT.items())
    by_length = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    cases = lambda i: " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[i]}'"
        for v, h, p in by_length
    )
    return f"""
    WITH a AS (SELECT page_id, coalesce(url, '') AS url,
                      CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
               FROM pages),
    b AS (SELECT page_id, {low('url')} AS u, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM a),
    c AS (SELECT page_id, u, {low('h')} AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b),
    d AS (SELECT *, ({strict_n})::INTEGER AS strict_hits, ({weight})::DOUBLE AS soft_weight FROM c)
    SELECT page_id, host, path, CASE {cases(0)} END AS rule,
           CASE {cases(1)} ELSE CASE WHEN strict_hits > 0 OR soft_weight >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END END
             AS verdict, strict_hits, soft_weight
    FROM d"""
