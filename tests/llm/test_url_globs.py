import fnmatch
import random
import re

from docketry.llm import url_globs as g


def plain(glob: str) -> re.Pattern:
    parts = {"**": ".*", "*": "[^/]*", "?": "."}
    return re.compile("".join(parts.get(t) or re.escape(t[1:]) for t in g.tokens(glob)), re.S)


def test_automaton_against_regular_expressions():
    rng = random.Random(5)
    letters = "ab/.-"
    globs = ["".join(rng.choice(["a", "b", "/", ".", "*", "**", "?"]) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    globs += ["", "*", "**", "?", "a" * 70 + "**", "\\*a", "**" + "ab" * 40]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    texts += ["", "*a", "a" * 70, "a" * 71 + "/b", "ab" * 40, "b" + "ab" * 40, "aé", "é\U0001f600"]
    fits = g.compile_globs(globs).matches(texts)
    for k, glob in enumerate(globs):
        pattern = plain(glob)
        assert [bool(x) for x in fits[:, k]] == [bool(pattern.fullmatch(t)) for t in texts], glob
    assert fnmatch.fnmatch("ab", "a*")


def test_no_texts():
    assert g.compile_globs(["a*"]).matches([]).shape == (0, 1)


URLS = {
    1: ("http://a.ORG/x", "a.org", "/x", "org/", "allow"),
    2: ("https://www.example.org/es/5?x", "www.example.org", "/es/5", "example.org/es/", "block"),
    3: ("https://example.org/en/17#t", "example.org", "/en/17", "example.org/en/1", "block"),
    4: ("https://notexample.org/es/5", "notexample.org", "/es/5", "org/", "allow"),
    5: ("http://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"),
    6: ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    7: ("http://x.com/en/1", "x.com", "/en/1", None, "allow"),
    8: ("http://spam-farm.example.net/en/1", "spam-farm.example.net", "/en/1", None, "block"),
    9: ("http://a.net/b.org/c", "a.net", "/b.org/c", None, "allow"),
    10: ("no scheme.org/", "", "", None, "allow"),
    11: (None, "", "", None, "allow"),
    12: ("", "", "", None, "allow"),
    13: ("http://a.org", "a.org", "", None, "allow"),
    14: ("http://a.org?x=/y", "a.org", "", None, "allow"),
    15: ("a://b://c.org/x", "b:", "//c.org/x", None, "allow"),
    16: ("http://É.ORG/é", "É.org", "/é", "org/", "allow"),
    17: ("http://a.org/" + "p" * 20000, "a.org", "/" + "p" * 20000, "org/", "allow"),
    18: ("http://a.net/x.exe", "a.net", "/x.exe", None, "block"),
}


def test_judged_rows(spark):
    rows = [(k, v[0], "clash", "clash") for k, v in URLS.items()] + [(None, URLS[1][0], "", ""), (1, URLS[1][0], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    found = [tuple(r) for r in g.judge(pages).collect()]
    wanted = [(k, *v[1:]) for k, v in URLS.items()] + [(None, *URLS[1][1:]), (1, *URLS[1][1:])]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert g.judge(pages.limit(0)).count() == 0


def test_longest_rule_wins_and_ties_go_to_the_later(spark):
    pages = spark.createDataFrame([(1, "http://a.b/cc")], "page_id long, url string")
    rules = [("allow", "b/"), ("block", "a.b/c"), ("allow", "a.b/c")]
    assert g.judge(pages, rules=rules).first()["verdict"] == "allow"
