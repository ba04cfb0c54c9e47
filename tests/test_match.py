"""Tiers against brute force, the log tests, and the known row counts."""

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordferry.operators import match, normalize
from recordferry.plans import queries as Q

DAY = dt.date(2025, 1, 1)
TARGET = "record_id string, record_number string, file_date date, volume int, page int, county_name string, county_id int"
SOURCE = "lease_id bigint, record_number string, record_date date, volume int, page int, county_name string, county_id int"
LOG = "record_id string, lease_id bigint, batch_tag string"


def key(text):
    return None if text is None else text.rstrip(" ").lower()


def same_place(t, s):
    return t[2] == s[2] and t[5].lower() == s[5].lower()


def contained(t, s):
    a, b = key(t[1]), key(s[1])
    return (a is not None and b is not None and len(a) != len(b) and min(len(a), len(b)) >= 5
            and (a in b or b in a) and same_place(t, s))


def exact(t, s):
    return key(t[1]) is not None and key(t[1]) == key(s[1]) and same_place(t, s)


def brute_contained(targets, sources):
    copies = Counter((s[2], s[5].lower(), key(s[1])) for s in sources)
    return Counter((t[0], s[0]) for t in targets for s in sources
                   if contained(t, s) and copies[(s[2], s[5].lower(), key(s[1]))] == 1)


def pairs(df):
    return Counter((r.target_record_id, r.source_lease_id) for r in df.collect())


def sides(seed, n=60, alphabet="12a", longest=12):
    rng = random.Random(seed)

    def number():
        return rng.choice([None, "", *["".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest)))
                                       for _ in range(6)]])

    def place():
        return DAY + dt.timedelta(rng.randint(0, 1)), rng.randint(1, 3), rng.randint(1, 3), rng.choice(["Eddy", "EDDY", "Jack"])

    targets, sources = [], []
    for i in range(n):
        d, v, p, c = place()
        targets.append((f"t{i}", number(), d, v, p, c, 1))
        d, v, p, c = place()
        sources.append((i, number(), d, v, p, c, 1))
    return targets, sources


@pytest.mark.parametrize("seed", range(3))
def test_tiers_equal_brute_force(rows, seed):
    targets, sources = sides(seed)
    t, s = rows(TARGET, *targets), rows(SOURCE, *sources)
    assert pairs(match.match_contained(t, s)) == brute_contained(targets, sources)
    assert pairs(match.match_exact(t, s)) == Counter((a[0], b[0]) for a in targets for b in sources if exact(a, b))
    differ = Counter((a[0], b[0]) for a in targets for b in sources if same_place(a, b) and a[3:5] == b[3:5]
                     and a[1] is not None and b[1] is not None and key(a[1]) != key(b[1]))
    assert pairs(match.match_volume_page(t, s)) == differ
    covered = {b[0] for a in targets for b in sources if exact(a, b) or contained(a, b)}
    got = {r.source_lease_id for r in match.leases_with_match(t, s).collect()}
    assert got == covered


@pytest.mark.parametrize("seed", range(3))
def test_long_numbers(rows, seed):
    """Long, repetitive numbers: anchors collide, pieces repeat."""
    targets, sources = sides(seed, n=40, alphabet="1122a", longest=60)
    base = "12" * 20
    targets += [("long", base, DAY, 1, 1, "Eddy", 1), ("tail", base[:30] + "a", DAY, 1, 1, "Eddy", 1)]
    sources += [(900, "a" + base + "a", DAY, 1, 1, "Eddy", 1), (901, base[:30], DAY, 1, 1, "Eddy", 1)]
    t, s = rows(TARGET, *targets), rows(SOURCE, *sources)
    got = pairs(match.match_contained(t, s))
    assert got == brute_contained(targets, sources)
    assert got[("long", 900)] == 1 and got[("tail", 901)] == 1
    covered = {b[0] for a in targets for b in sources if exact(a, b) or contained(a, b)}
    assert {r.source_lease_id for r in match.leases_with_match(t, s).collect()} == covered


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab1 ", max_size=30), min_size=1, max_size=6))
def test_index_holds_each_gram_once_and_each_number_under_a_rarest_gram(rows, texts):
    df = rows("i int, text string", *enumerate(texts))
    indexed = match.index_numbers(df, "text", match.gram_frequency(df.select("text")), 0, 1, equal=True)
    got = Counter((r.i, r.role, r.contained_key) for r in indexed.collect())
    own = [{t[a:a + 5] for a in range(len(t) - 4)} for t in texts]
    held = Counter(g for grams in own for g in grams)
    want = Counter({(i, 0, g) for i, t in enumerate(texts) if len(t) > 5 for g in own[i]})
    want += Counter((i, match.EQUAL, t) for i, t in enumerate(texts))
    wholes = {i: k for i, role, k in got if role == 1}
    assert set(wholes) == {i for i, t in enumerate(texts) if len(t) >= 5}
    # grams may share a bucket, which is very unlikely for so few
    assert all(held[k] == min(held[g] for g in own[i]) for i, k in wholes.items())
    assert got - Counter((i, 1, k) for i, k in wholes.items()) == want


@pytest.mark.parametrize("buckets", [1, 3])
def test_few_buckets_change_no_match(rows, monkeypatch, buckets):
    monkeypatch.setattr(match, "GRAM_BUCKETS", buckets)
    targets, sources = sides(7, n=50, alphabet="112a", longest=14)
    t, s = rows(TARGET, *targets), rows(SOURCE, *sources)
    assert pairs(match.match_contained(t, s)) == brute_contained(targets, sources)


def test_a_frequent_gram_is_not_the_key(rows):
    """A prefix that all numbers share: no number is indexed under it, so it joins with nothing."""
    targets = [(f"t{i}", f"2020-00{i:05d}", DAY, 1, 1, "Eddy", 1) for i in range(200)]
    sources = [(i, f"2020-00{i:05d}/A", DAY, 2, 2, "Eddy", 1) for i in range(200)]
    t, s = rows(TARGET, *targets), rows(SOURCE, *sources)
    report = {r.side: r for r in match.index_report(t, s).collect()}
    assert report["target"].findable == 200 and report["target"].grams <= 200 * 8
    numbers = (match.distinct_keys(match._source_side(s), "source_key", match.PLACE),
               match.distinct_keys(match._target_side(t), "target_key", match.PLACE))
    frequency = match.gram_frequency(numbers[0].select("source_key"), numbers[1].select("target_key"))
    keys = match._index_sides(numbers[0], "source_key", numbers[1], "target_key", frequency)
    assert keys[1].where("role = 0 and contained_key in ('2020-', '020-0', '20-00')").isEmpty()
    assert pairs(match.match_contained(t, s)) == brute_contained(targets, sources)


def test_one_county_day_holding_most_rows(rows):
    """A hot county-day and a hot number: results stay whole."""
    targets = [(f"t{i}", f"{100000 + i}", DAY, 1, 1, "Eddy", 1) for i in range(300)]
    targets += [(f"h{i}", "777777", DAY, 1, 1, "Eddy", 1) for i in range(150)]
    sources = [(i, f"X{100000 + i}-1", DAY, 2, 2, "Eddy", 1) for i in range(300)]
    sources += [(1000, "A777777", DAY, 2, 2, "Eddy", 1)] + [(2000 + i, "B777777", DAY, 2, 2, "Eddy", 1) for i in range(50)]
    got = pairs(match.match_contained(rows(TARGET, *targets), rows(SOURCE, *sources)))
    assert got == brute_contained(targets, sources)
    assert sum(got.values()) == 300 + 150


def test_log_tests_differ(rows):
    """No log row, a row without lease, and both kinds of rows."""
    pairs_df = rows("target_record_id string, source_lease_id bigint", ("none", 1), ("open", 2), ("done", 3), ("both", 4))
    log = rows(LOG, ("open", None, "x"), ("open", None, "y"), ("done", 5, "x"), ("both", 6, "x"), ("both", None, "y"))

    def ids(df):
        return sorted(r.target_record_id for r in df.collect())

    assert ids(match.unexported(pairs_df, log)) == ["none", "open"]
    assert ids(match.unexported(pairs_df, log, "reference")) == ["both", "none", "open", "open"]
    assert sorted(r.source_lease_id for r in match.not_logged(pairs_df, log).collect()) == [1, 2, 3, 4]
    more = log.unionByName(rows(LOG, ("q", 2, "x")))
    assert sorted(r.source_lease_id for r in match.not_logged(pairs_df, more).collect()) == [1, 3, 4]


def test_legacy_match_counts_a_pair_once(rows):
    """Volume equals the number and the digits contain each other."""
    targets = [("t1", "9123456", DAY, 123456, 1, "Eddy", 1), ("t2", "123456", DAY, 123456, 1, "Eddy", 1)]
    sources = [(1, "AB-123456", DAY, 2, 2, "Jack", 2)]
    t, s = normalize.digits_slice(rows(TARGET, *targets)), normalize.digits_slice(rows(SOURCE, *sources))
    got = pairs(match.match_any_legacy(t, s, rows(LOG, ("x", 1, "y"))))
    assert got == Counter({("t1", 1): 1, ("t2", 1): 1})


def test_fill_choices_take_the_least_lease_and_count_the_rest(rows):
    target = rows(TARGET, ("r1", "A1", DAY, 1, 1, "Eddy", 1), ("r2", "B1", DAY, 1, 1, "Eddy", 1))
    source = rows(SOURCE, (7, "a1 ", DAY, 1, 1, "Eddy", 1), (5, "A1", DAY, 1, 1, "Eddy", 1), (6, "B1", DAY, 1, 1, "Jack", 2))
    log = rows(LOG, ("r1", None, "x"), ("r2", None, "x"))
    got = match.log_fill_choices(log, target, source).collect()
    assert [(r.target_record_id, r.source_lease_id, r.candidates) for r in got] == [("r1", 5, 2)]


def test_first_file_and_per_file_ids(spark, bindings):
    chosen = Q.full_source(bindings)
    assert chosen.count() == chosen.select("lease_id").distinct().count()
    per_file = Q.full_source(bindings, "reference")
    assert per_file.count() > chosen.count()
    issued = bindings.issued_ids.join(chosen, "lease_id").where("record_id = generated_record_id").count()
    assert issued == bindings.issued_ids.count()


KNOWN = {"match_exact": 5714, "match_volpage": 2377, "match_union_distinct": 8091, "match_exact_by_log_status": 6286,
         "match_substring": 1571, "source_only": 5358, "stage_candidates_by_log": 11007}


@pytest.mark.parametrize("name, count", KNOWN.items())
def test_known_counts(bindings, name, count):
    assert Q.QUERIES[name](bindings).count() == count


def test_known_key_counts(bindings):
    source = Q.source_slice(bindings)
    raw = bindings.src_lease.selectExpr("try_cast(trim(vol) as int) v").where("v is not null").count()
    assert (raw, source.where("volume is not null").count()) == (12587, 12562)


def test_tiers_are_disjoint_where_claimed(bindings):
    t, s = Q.target_slice(bindings), Q.source_slice(bindings)
    ids = ["target_record_id", "source_lease_id"]
    one, two, three = (df.select(*ids) for df in (
        match.match_exact(t, s), match.match_volume_page(t, s), match.match_contained(t, s)))
    assert one.intersect(two).isEmpty() and one.intersect(three).isEmpty()
