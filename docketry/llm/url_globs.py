"""URL filter: a bit-parallel automaton runs all wildcard rules at once over each canonical URL.

Every glob is a row of literal positions. The masks of all globs lie side by side in 64-bit words; one step of
Shift-And moves every state of every glob by one character. ``*`` (any run without ``/``), ``**`` (any run)
and ``?`` (one character) become self-loop bits and full mask bits, so a star costs no extra state.

Null cases: a URL that is null or has no ``://`` has an empty host and path, fits no rule and gets the verdict of
the globs on the empty string (allow, unless a glob fits it). A URL is read to its end, however long. Repeated rows are
judged alike; an empty table gives an empty result; columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, table

#: (verdict, host and path) of the contract's rules.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Block globs for URLs that no rule fits; matched over ``.host/path``. Everything else is allowed.
BLOCK_GLOBS = ("*spam-*/**", "*-pills.*/**", "*casino*/**", "**/porn/**", "**.exe", "**.zip")


@dataclass(frozen=True)
class Automaton:
    """Masks of all globs, packed; ``classes`` maps code points to mask rows, row 0 is any other one."""

    classes: np.ndarray  # code point -> row, for code points below its length
    step: np.ndarray  # row x word: positions that the character may take
    loop: np.ndarray  # row x word: positions that stay on the character
    start: np.ndarray  # word: first position of each glob
    final: np.ndarray  # glob x word: its last position

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """texts x globs: whether the whole text fits. Time: characters x words, whatever the globs."""
        fits = np.zeros((len(texts), len(self.final)), dtype=bool)
        if not len(texts):
            return fits
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        points = np.frombuffer("".join(texts[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
        rows = np.where(points < len(self.classes), self.classes[np.minimum(points, len(self.classes) - 1)], 0)
        at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        # Texts lie longest first, so those with a character at place t are the first ones.
        active = np.searchsorted(-lengths, -np.arange(1, int(lengths[0]) + 1), side="right")
        for t, n in enumerate(active):
            row, now = rows[at[:n] + t], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[row]) | (now & self.loop[row])
        for k, last in enumerate(self.final):
            fits[order, k] = ((state & last) != 0).any(axis=1)
        return fits


def tokens(glob: str) -> list[str]:
    """The glob's literals, ``?``, ``*`` and ``**``; a backslash makes the next character a literal."""
    out, i = [], 0
    while i < len(glob):
        if glob[i] == "\\" and i + 1 < len(glob):
            out.append("=" + glob[i + 1])
            i += 2
        elif glob.startswith("**", i):
            out.append("**")
            i += 2
        elif glob[i] in "*?":
            out.append(glob[i])
            i += 1
        else:
            out.append("=" + glob[i])
            i += 1
    return out


def compile_globs(globs: Sequence[str]) -> Automaton:
    """Packs the globs; each takes as many bits as it has literals and ``?``, and one to start from."""
    parsed = [tokens(g) for g in globs]
    letters = sorted({t[1] for p in parsed for t in p if t[0] == "="} | {"/"})
    row_of = {c: i + 1 for i, c in enumerate(letters)}
    classes = np.zeros(max(map(ord, letters)) + 2, np.int64)
    for c, i in row_of.items():
        classes[ord(c)] = i
    bits = sum(1 + sum(t not in ("*", "**") for t in p) for p in parsed)
    words = max(1, -(-bits // 64))
    step = np.zeros((len(letters) + 1, words), np.uint64)
    loop = np.zeros_like(step)
    start = np.zeros(words, np.uint64)
    final = np.zeros((len(globs), words), np.uint64)
    at = 0
    for k, parts in enumerate(parsed):
        start[at // 64] |= np.uint64(1) << np.uint64(at % 64)
        for t in parts:
            if t in ("*", "**"):
                # Stars side by side share a state, which keeps what any of them passes.
                passes = np.ones(len(loop), bool)
                passes[row_of["/"]] = t == "**"
                loop[passes, at // 64] |= np.uint64(1) << np.uint64(at % 64)
                continue
            at += 1
            bit = np.uint64(1) << np.uint64(at % 64)
            if t == "?":
                step[:, at // 64] |= bit
            else:
                step[row_of[t[1]], at // 64] |= bit
        final[k, at // 64] = np.uint64(1) << np.uint64(at % 64)
        at += 1
    return Automaton(classes, step, loop, start, final)


def rule_glob(rule: str) -> str:
    """A host rule as a glob over ``.host/path``: the host or a subdomain, and a path with the prefix."""
    quoted = "".join("\\" + c if c in "*?\\" else c for c in rule)
    return f"*.{quoted}**"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for null and for a URL without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def judge(
    urls: DataFrame,
    url_id: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    block_globs: Sequence[str] = BLOCK_GLOBS,
) -> DataFrame:
    """(id, host, path, rule, verdict) of each row. The longest fitting rule decides (of two of the same
    length, the later one); without one, ``block`` if any block glob fits, else ``allow``. ``rule`` is null
    where no rule fits. Rows are judged one by one: no shuffle, repeated rows get the same answer."""
    machine = compile_globs([*(rule_glob(r) for _, r in rules), *block_globs])
    names = np.array([r for _, r in rules] + [None], dtype=object)
    verdicts = np.array([v for v, _ in rules], dtype=object)
    ranked = sorted(range(len(rules)), key=lambda i: len(rules[i][1]))

    @arrow_udf("rule string, verdict string")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            fits = machine.matches(texts.tolist())
            best = np.full(len(texts), -1)
            for i in ranked:
                best[fits[:, i]] = i
            blocked = fits[:, len(rules) :].any(axis=1)
            verdict = np.where(blocked, "block", "allow").astype(object)
            verdict[best >= 0] = verdicts[best[best >= 0]] if len(verdicts) else "allow"
            yield pd.DataFrame({"rule": names[best], "verdict": verdict})

    host, path = host_and_path(F.col(url))
    split = urls.select(F.col(url_id).alias("page_id"), host.alias("host"), path.alias("path"))
    judged = split.withColumn("found", decide(F.concat(F.lit("."), "host", "path")))
    return judged.select("page_id", "host", "path", "found.rule", "found.verdict")


def op4_url_globs(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _sql() -> str:
    cases = "\n".join(
        f"    UNION ALL SELECT '{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}'" for v, r in RULES
    )
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules AS (SELECT '' AS rule, '' AS rule_host, '' AS rule_path, '' AS verdict WHERE FALSE
{cases}),
best AS (
  SELECT s.page_id, s.host, s.path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id, s.host, s.path ORDER BY length(r.rule) DESC NULLS LAST) AS place
  FROM split s LEFT JOIN rules r
    ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path))
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN verdict
            WHEN host LIKE '%spam-%' AND path <> '' OR host LIKE '%-pills.%' AND path <> ''
                 OR host LIKE '%casino%' AND path <> '' OR path LIKE '%/porn/%'
                 OR ('.' || host || path) LIKE '%.exe' OR ('.' || host || path) LIKE '%.zip'
            THEN 'block' ELSE 'allow' END AS verdict
FROM best WHERE place = 1"""


QUERIES = {"op4_url_globs": op4_url_globs}
ORACLES = {"op4_url_globs": _sql()}
