"""Quality rules, chat perspectives and URL rules."""

import random
import re

from vejrkraft.llm import chat, quality_rules, url_rules

DOCS = "doc_id long, text string, n_words string, words array<string>, runs int"


def _measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside.update(range(i, i + 8))
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(inside),
    )


def test_measures_equal_a_plain_count(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "one", "a b c d e f g h", "a " * 30, "é# ß|\nx\n\nx\r\ny <b>", "long " * 20_000]
    texts += [
        "".join(rng.choice(["a", "b", "cc", " ", " ", "\n", "*"]) for _ in range(rng.randrange(300))) for _ in range(150)
    ]
    rows = [(i, t, "x", ["y"], 1) for i, t in enumerate(texts)] + [(None, "a b", None, None, None)] * 2
    got = quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, t in enumerate(texts):
        r = by_id[i]
        m = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert i == 7 or m == _measures(t), (t, m)
        assert r["base_failed"] == (m[0] < 20 or 100 * m[4] > 30 * m[0])
        assert not (r["base_failed"] and r["kept"])
    assert by_id[7]["n_repeat_words"] == 20_000


def test_order_does_not_change_the_verdict(spark):
    texts = ["good plain words of a text " * 1 + " ".join(f"word{chr(97 + i % 26)}{i}" for i in range(40))]
    texts += [" ".join("*** x" for _ in range(25)) + f" {i}" for i in range(3)]
    texts += [" ".join(f"WORD{i}A" for i in range(40)), " ".join(str(i * 1000) for i in range(40))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    names = list(quality_rules.RULES)
    results = [
        sorted((r["doc_id"], r["kept"]) for r in quality_rules.quality_rules(df, order=o).collect())
        for o in (names, names[::-1], None)
    ]
    assert results[0] == results[1] == results[2]
    assert [k for _, k in results[0]] == [True, False, False, False, False, False]


def test_costs_are_estimated_and_empty_tables_pass(spark):
    empty = spark.createDataFrame([], DOCS)
    assert quality_rules.quality_rules(empty).count() == 0
    df = spark.createDataFrame([(1, "# # #")], "doc_id long, text string")
    found = quality_rules.rule_costs(df)
    assert {r["rule"] for r in found} == set(quality_rules.RULES)
    assert found[0]["rejected"] == 1 and all(r["seconds"] > 0 for r in found)


def test_perspectives(spark):
    rows = [
        (1, 0, "ann", "hi", "x"), (1, 1, "bob", None, "x"), (1, 2, None, "<|end|> no", "x"), (1, 2, None, "<|end|> no", "x"),
        (None, 0, "ann", "alone", "x"), (2, None, "bob", "", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, perspective string")
    got = chat.rotate_perspectives(df).collect()
    assert len(got) == 4 * 3 + 1 + 1
    for r in got:
        own = r["speaker"] == r["perspective"]
        assert (r["chat_role"] == "assistant") == own and (r["name"] is None) == own
        learnt = r["rendered"][r["mask_start"] : r["mask_start"] + r["mask_length"]]
        assert (r["mask_length"] > 0) == own
        if own:
            assert learnt.endswith("<|end|>") and r["rendered"] == "<|turn|>assistant\n" + learnt + "\n"
        assert r["rendered"].count("<|end|>") == 1
    ann = [r for r in got if (r["conv_id"], r["perspective"]) == (1, "ann")]
    assert sorted(r["rendered"] for r in ann if r["turn"] == 0) == ["<|turn|>assistant\nhi<|end|>\n"]
    assert chat.rotate_perspectives(df.limit(0)).count() == 0


def _judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_url_rules_equal_a_plain_search(spark):
    rng = random.Random(5)
    labels, parts = ["a", "b", "c", "org", "x"], ["/", "/a", "/b", "/a/b", "", "/a/b/c", "?q=/a", "#f"]
    rules = {}
    for _ in range(60):
        h = ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4)))
        p = "".join(rng.choice(parts[:6]) for _ in range(rng.randrange(0, 3)))
        rules[h, p] = rng.choice(["allow", "block"])
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [None, "", "no scheme", "http://", "http:///a", "HTTP://A.Org/a?b://c", "x://a.b.org"] + [
        "http://" + ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 6)))
        + "".join(rng.choice(parts) for _ in range(rng.randrange(0, 4)))
        for _ in range(400)
    ]
    urls += ["http://a.org/a/" + "z" * 20_000] * 3
    rows = [(i, u, "clash", 1) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, key int")
    got = url_rules.judge_urls(pages, rules).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == _judge(urls[r["page_id"]], rules), r["url"]
    as_table = spark.createDataFrame(rules + [(None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    again = url_rules.judge_urls(pages, as_table).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_urls_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert url_rules.judge_urls(pages, []).first()["verdict"] == "allow"
    assert url_rules.judge_urls(pages.limit(0), [("b", "/", "block")]).count() == 0
