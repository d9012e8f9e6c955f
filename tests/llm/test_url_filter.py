import random
import re

from candlehouse.llm import url_filter as U
from candlehouse.llm.queries import RULES


def as_regex(glob: str) -> re.Pattern:
    parts = re.split(r"(\*+|\?)", glob)
    return re.compile("".join(
        "[^/]" if p == "?" else "[^/]*" if p == "*" else "(?s:.*)" if p.startswith("**") else re.escape(p) for p in parts))


def test_automaton_against_regular_expressions():
    rng = random.Random(3)
    for _ in range(60):
        globs = ["".join(rng.choice(["a", "b", "/", "?", "*", "**", ".", "ab"]) for _ in range(rng.randint(0, 9)))
                 for _ in range(rng.randint(1, 25))]
        urls = ["".join(rng.choice("ab/.é") for _ in range(rng.randint(0, 12))) for _ in range(40)] + ["", "/", "a" * 500]
        patterns = [as_regex(g) for g in globs]
        expected = [next((i for i, p in enumerate(patterns) if p.fullmatch(u)), -1) for u in urls]
        assert U.Automaton(globs).matches(urls).tolist() == expected, globs


def judged(spark, urls):
    df = spark.createDataFrame([(i, u, "mine", "mine", "mine") for i, u in enumerate(urls)],
                               "page_id bigint, url string, host string, verdict string, first string")
    found = U.judge(df, RULES)
    assert found.columns == ["page_id", "url", "first", "host", "path", "rule", "verdict"]
    return [(r.host, r.path, r.rule, r.verdict) for r in found.orderBy("page_id").collect()]


def test_rules(spark):
    long = "https://a.org/" + "x" * 100_000
    urls = [None, "", "no scheme org/", "http://", "http://Sub.EXAMPLE.org/es/Q?x#y", "https://example.org/en/12", "https://example.org/EN/12",
            "ftp://notexample.org/es/", "http://a.com/fr/", "http://a.com/de/x", "http://com/de/", "http://x.net/.org/", "http://a.org",
            "http://a.org?q=/", "http://a.org#/", "x://y://a.org/", "http://a.org/1", "http://a.org/1", "http://É.org/\nz", long]
    found = judged(spark, urls)
    assert found == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("sub.example.org", "/es/Q", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "/EN/12", "org/", "allow"), ("notexample.org", "/es/", "org/", "allow"), ("a.com", "/fr/", "com/fr/", "allow"),
        ("a.com", "/de/x", "com/de/", "block"), ("com", "/de/", "com/de/", "block"), ("x.net", "/.org/", None, "allow"),
        ("a.org", "", None, "allow"), ("a.org", "", None, "allow"), ("a.org", "", None, "allow"), ("y:", "//a.org/", None, "allow"),
        ("a.org", "/1", "org/", "allow"), ("a.org", "/1", "org/", "allow"), ("É.org", "/\nz", "org/", "allow"),
        ("a.org", long[len("https://a.org"):], "org/", "allow")]


def test_no_pages_and_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert U.judge(df.limit(0), RULES).collect() == []
    assert [(r.rule, r.verdict) for r in U.judge(df, [], default="block").collect()] == [(None, "block")]
