"""URL filters (operator 2): a bit-parallel wildcard automaton.

A rule is ``host/path`` and holds for the host, its subdomains, and paths that
start with its path; the longest rule that fits decides, of equally long ones
the last. ``*`` and ``?`` in a rule are wildcards (in the host they stop at its
end). Each rule becomes two glob patterns over the canonical url (host plus
path): one for the host itself, one for subdomains. All patterns share one row
of bits, a bit for every number of characters matched, over as many 64-bit words
as it takes. One step reads one character of every url of a batch: bits move up
by one where the character fits (Shift-And, with carries between words) and
stay where a wildcard allows the character. Patterns lie in order of rule
length, so the highest accepting bit left at the end names the rule.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, A-Z lower-cased; the path follows up to ``?``, ``#`` or the
end. A NULL url, or one without ``://``, has an empty host and path. Where no
rule fits, the rule is NULL and the verdict is ``default``. Only the id and the
url are read; repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm.common import lower_ascii, table

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
PADDED = 1 << 22  # characters in the matrix of a step, padding included
END = 256  # stands after the end of a url: every bit stays


class Automaton:
    """Patterns of ``rules`` as masks per character; ``match`` gives a rule's number or -1."""

    def __init__(self, rules: list[str]):
        order = sorted(range(len(rules)), key=lambda i: (len(rules[i]), i))
        steps: list[tuple[bool, set[int], set[int]]] = []  # per bit: start, characters that reach it, that keep it
        self.accept: list[tuple[int, int]] = []
        all_, in_host = set(range(256)), set(range(256)) - {ord("/")}
        for i in order:
            host, slash, path = rules[i].partition("/")
            for prefix in ("", "*."):
                steps.append((True, set(), set()))
                whole = (prefix + host).encode(), (slash + path + "*").encode()
                for part, every in zip(whole, (in_host, all_)):
                    for c in part:
                        if c == ord("*"):
                            steps[-1][2].update(every)
                        else:
                            steps.append((False, set(every) if c == ord("?") else {c}, set()))
                self.accept.append((len(steps) - 1, i))
        words = -(-len(steps) // 64) or 1
        self.start = np.zeros(words, np.uint64)
        self.reach, self.stay = np.zeros((END + 1, words), np.uint64), np.zeros((END + 1, words), np.uint64)
        self.stay[END] = ~np.uint64(0)
        for bit, (first, reach, stay) in enumerate(steps):
            w, x = bit // 64, np.uint64(1 << (bit % 64))
            if first:
                self.start[w] |= x
            for c in reach:
                self.reach[c, w] |= x
            for c in stay:
                self.stay[c, w] |= x

    def _run(self, urls: list[bytes]) -> np.ndarray:
        size = np.array([len(u) for u in urls])
        chars = np.full((len(urls), size.max(initial=0)), END, np.int16)
        flat = np.frombuffer(b"".join(urls), np.uint8)
        chars[np.arange(chars.shape[1]) < size[:, None]] = flat
        state = np.tile(self.start, (len(urls), 1))
        for t in range(chars.shape[1]):
            c = chars[:, t]
            moved = state << np.uint64(1)
            moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
            state = (moved & self.reach[c]) | (state & self.stay[c])
        rule = np.full(len(urls), -1, np.int32)
        for bit, i in self.accept:  # shortest rule first: a longer one overwrites it
            rule[(state[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)).astype(bool)] = i
        return rule

    def match(self, urls: list[bytes]) -> np.ndarray:
        out = np.full(len(urls), -1, np.int32)
        order = sorted(range(len(urls)), key=lambda i: len(urls[i]))  # urls of like length share a matrix
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * len(urls[order[stop]]) <= PADDED:
                stop += 1
            pick = order[at:stop]
            out[pick] = self._run([urls[i] for i in pick])
            at = stop
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules=RULES, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict): a row per row of ``pages``."""
    machine = Automaton([r for _, r in rules])

    def run(urls: pd.Series) -> pd.Series:
        return pd.Series(machine.match(list(urls)))

    host, path = host_and_path(F.col("url"))
    got = pages.select("page_id", host.alias("host"), path.alias("path"))
    got = got.withColumn("at", F.pandas_udf(run, "int")(F.concat("host", "path").cast("binary")) + 1)
    name = F.array(*[F.lit(r) for _, r in rules]).cast("array<string>")
    verdict = F.array(*[F.lit(v) for v, _ in rules]).cast("array<string>")
    return got.select("page_id", "host", "path", F.when(F.col("at") > 0, F.try_element_at(name, "at")).alias("rule"),
                      F.when(F.col("at") > 0, F.try_element_at(verdict, "at")).otherwise(default).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a FROM pages),
hosts AS (SELECT *, regexp_extract(a, '^[^/?#]*') AS raw FROM parts),
split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(a, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT s.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  GROUP BY s.page_id)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f USING (page_id)
"""
