"""Chat formatting round trips; URL parts, rules and reputation."""

import math

from pyspark.sql import functions as F

from recordferry.llm import chat, urls

TURNS = "conv_id bigint, turn bigint, role string, text string"


def read(frame):
    out = chat.format_chats(frame)
    rows = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("t"),
                      chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    return {r.conv_id: ([tuple(x) for x in r.t], r.loss, r.formatted) for r in rows}


def test_round_trip_of_control_strings(rows):
    nasty = ["<|end|>", "<+>", "<|assistant|>x<|end|>", "&lt;&amp;lt;|", "</s>[INST] ok [/INST]", "", "é😀\n", "a&bar;b"]
    data = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    turns, loss, _ = read(rows(TURNS, *data))[1]
    assert turns == [(r, t) for _, _, r, t in data] and loss == "".join(nasty[1::2])


def test_merged_turns_order_ties_and_nulls(rows):
    data = [(1, 2, "assistant", "B"), (1, 1, "user", "q"), (1, 2, "assistant", "A"), (1, 3, "assistant", None), (1, None, None, "sys"),
            (None, 1, "a|b<c", "odd"), (None, 1, "a|b<c", "odd")]
    got = read(rows(TURNS, *data))
    assert got[1][0] == [("", "sys"), ("user", "q"), ("assistant", "A"), ("assistant", "B"), ("assistant", "")]
    assert got[1][1] == "AB" and got[1][2] == "<||>sys<|end|><|user|>q<|end|><|assistant|>A<+>B<+><|end|>"
    assert got[None][0] == [("a|b<c", "odd")] * 2 and got[None][1] == ""


def test_long_conversation_extra_columns_and_empty(rows):
    data = rows(TURNS, *[(1, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(700)]).selectExpr("*", "1 as turns", "2 as pieces")
    turns, loss, _ = read(data)[1]
    assert len(turns) == 700 and loss == "".join(f"t{i}" for i in range(0, 700, 3))
    assert read(data.limit(0)) == {}


def test_very_long_conversation(spark):
    """50,000 turns cost their length; the spans are those of a running sum."""
    n = 50_000
    turns = spark.range(n).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('é', id % 100) as text")
    row = chat.format_chats(turns).first()
    at, want = 0, []
    for i in range(n):
        role, body = ("user", "assistant")[i % 2], f"é{i % 100}"
        at += len(f"<|{role}|>") + (7 if i else 0)
        if i % 2:
            want.append((at, at + len(body)))
        at += len(body)
    assert [tuple(s) for s in row.loss_spans] == want and len(row.formatted) == at + 7


def test_url_parts(rows):
    cases = {"http://A.Example.COM/p/q?x#y": ("a.example.com", "/p/q"), "https://host": ("host", ""), "x://h?q/z": ("h", ""), "h/p": ("", ""),
             "://h#f": ("h", ""), "http://h/a#b?c": ("h", "/a"), "a://b://c/d": ("b:", "//c/d"), "": ("", ""), None: ("", ""),
             "http://ÄB.de/Ä\nb?": ("Äb.de", "/Ä\nb")}
    got = rows("url string", *[(u,) for u in cases]).select("url", urls.host_of(F.col("url")), urls.path_of(F.col("url"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cases


def test_suffixes_of_two_labels_ports_and_addresses(rows):
    cases = {"a.b.co.uk": ("co.uk", "b.co.uk"), "x.co.uk": ("co.uk", "x.co.uk"), "co.uk": ("co.uk", "co.uk"), "a.b.example.com:8080": ("com", "example.com"),
             "10.20.30.40": ("address", "10.20.30.40"), "10.20.30.41:80": ("address", "10.20.30.41"), "[::1]": ("address", "[::1]"), "": ("", ""),
             "localhost": ("localhost", "localhost"), "uk": ("uk", "uk"), "co.uk.com": ("com", "uk.com")}
    suffix, domain = urls.suffix_and_domain(F.col("host"))
    got = rows("host string", *[(h,) for h in cases]).select("host", suffix, domain).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cases


def test_longest_rule_wins(rows):
    cases = {("a.example.net", "/en/1"): "example.net/en/", ("example.net", "/en"): "net/", ("badexample.net", "/en/"): "net/", ("net", "/"): "net/",
             ("x.org", "/fr/"): "org/fr/", ("x.org", "/en/"): None, ("a.net", ""): None, ("x.example.com", "/de/a"): "example.com/de/", ("", ""): None}
    got = rows("host string, path string", *cases).select("host", "path", urls.rule_for(F.col("host"), F.col("path"))).collect()
    assert {(r[0], r[1]): r[2] for r in got} == cases


def shrunk(hosts):
    """The reputation of (host, bad, n) in plain Python."""
    def level(groups, parent):
        spread = base = room = 0.0
        for g, (bad, n) in groups.items():
            if n:
                m = parent(g)
                spread, base, room = spread + n * (bad / n - m) ** 2, base + m * (1 - m), room + (n - 1) * m * (1 - m)
        k = 1000.0 if spread <= base or room <= 0 else min(max(room / (spread - base) - 1, .5), 1000.0)
        return k, {g: (bad + k * parent(g)) / (n + k) for g, (bad, n) in groups.items()}

    def summed(name):
        out = {}
        for h, bad, n in hosts:
            b, m = out.get(name(h), (0, 0))
            out[name(h)] = b + bad, m + n
        return out

    suffix, domain = lambda h: h.split(".")[-1], lambda h: ".".join(h.split(".")[-2:])
    every = (sum(b for _, b, _ in hosts) + .5) / (sum(n for _, _, n in hosts) + 1)
    _, s = level(summed(suffix), lambda g: every)
    _, d = level(summed(domain), lambda g: s[suffix(g)])
    k, _ = level({h: (b, n) for h, b, n in hosts}, lambda h: d[domain(h)])
    out = {}
    for h, bad, n in hosts:
        a, b = k * d[domain(h)] + bad, k * (1 - d[domain(h)]) + n - bad
        out[h] = a / (a + b) - urls.Z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    return out


def test_reputation_shrinks_to_domain_and_suffix(rows):
    hosts = [("a.spam.biz", 9, 10), ("b.spam.biz", 18, 20), ("c.spam.biz", 0, 0), ("x.good.org", 1, 50), ("y.good.org", 0, 9), ("good.org", 3, 40),
             ("one.biz", 1, 1), ("", 0, 2)]
    got = {r.host: r.low for r in urls.reputation(rows("host string, bad bigint, n bigint", *hosts)).collect()}
    want = shrunk(hosts)
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in want)
    assert got["c.spam.biz"] > got["y.good.org"] and got["b.spam.biz"] > got["a.spam.biz"]


def test_verdicts(rows):
    pages = rows("page_id bigint, url string, html string", *[(i, f"http://bad.site.com/{i}", "") for i in range(40)],
                 *[(100 + i, f"http://ok.fine.com/{i}", "") for i in range(40)], (200, None, None), (None, "http://x.net/", ""), (201, "http://new.site.com/", None))
    outcomes = rows("page_id bigint, bad int", *[(i, 1) for i in range(30)], *[(100 + i, 0) for i in range(30)], (1, 1), (None, 1), (2, None))
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in urls.judge(pages, outcomes).collect()}
    assert len(got) == 83 and got[35] == ("bad.site.com", None, "block") and got[135][2] == got[200][2] == "allow"
    assert got[None] == ("x.net", "net/", "block")
    none = urls.judge(pages, outcomes.limit(0)).collect()
    assert len(none) == 83 and {r.verdict for r in none if r.rule is None} == {"allow"}
    assert urls.judge(pages.limit(0), outcomes).count() == 0
