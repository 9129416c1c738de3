"""Mixing (1), quality rules (7), exact dedup (10)."""

from collections import defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from sprout.llm import exact_dedup, mixing, quality_rules


def test_mixing_plan(odd):
    rows = mixing.plan(odd).collect()
    size, count = defaultdict(int), defaultdict(int)
    for r in odd.collect():
        size[r["source"]] += len(brute.words(r["text"]))
        count[r["source"]] += 1
    want = brute.targets(dict(size))
    assert len(rows) == odd.count()
    for r in rows:
        assert r["target"] in [pytest.approx(t) for t in want.values()]
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
        assert r["copies"] in (int(r["rate"]), int(r["rate"]) + 1)
    assert {(r["source_size"], round(r["target"], 6)) for r in rows} == {(size[s], round(want[s], 6)) for s in size}
    assert sorted(map(str, rows)) == sorted(map(str, mixing.plan(odd.repartition(5)).collect()))


def test_mix_emits_the_planned_copies(odd, clashing):
    plan = {r["doc_id"]: r["copies"] for r in mixing.plan(odd).filter("doc_id IS NOT NULL").collect()}
    seen = {r["doc_id"]: r["count"] for r in mixing.mix(odd).filter("doc_id IS NOT NULL").groupBy("doc_id").count().collect()}
    rows = {r["doc_id"]: r["count"] for r in odd.groupBy("doc_id").count().collect()}
    assert seen == {i: n * rows[i] for i, n in plan.items() if n}
    assert mixing.mix(clashing).columns == clashing.columns


def test_mixing_many_sources_match_the_brute_force(spark):
    rows = [(i, f"s{i * 7919 % 101}", "w " * (i % 97)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    size = defaultdict(int)
    for _, s, t in rows:
        size[s] += len(t.split())
    want = brute.targets(dict(size))
    got = {r["source"]: r["target"] for r in mixing.source_rates(mixing.sizes(docs)).collect()}
    assert got == {s: pytest.approx(t) for s, t in want.items()}
    assert sum(got.values()) == pytest.approx(1.5 * sum(size.values()))


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
                                     F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    taken = mixing.plan(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.03 * r["target"] for r in taken)


def test_mixing_nothing(nothing):
    assert mixing.plan(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0


def test_measurements(texts):
    for t in texts:
        want = brute.measures(t)
        assert dict(zip(quality_rules.MEASURES, quality_rules.measure(t.encode()), strict=True)) == want


def test_ledger_policies_and_ablations(odd):
    rows = quality_rules.ledger(odd)
    got = rows.collect()
    assert len(got) == odd.count()
    for r in got:
        m = {k: r[k] for k in quality_rules.MEASURES}
        bits = sum(1 << i for i, rule in enumerate(quality_rules.RULES.values()) if eval(rule, {}, m))
        assert r["fail_bits"] == bits
    for policy in quality_rules.POLICIES:
        mask = quality_rules.mask(policy)
        table = {r["rule"]: (r["failed"], r["only_it"]) for r in quality_rules.ablations(rows, policy).collect()}
        for i, rule in enumerate(quality_rules.RULES):
            if mask >> i & 1:
                own = [r["fail_bits"] & mask for r in got]
                assert table[rule] == (sum(b >> i & 1 for b in own), sum(b == 1 << i for b in own))


def test_rules_keep_rows_and_columns(clashing, odd):
    kept = quality_rules.keep_passing(clashing)
    assert kept.columns == clashing.columns
    mask = quality_rules.mask(quality_rules.DEFAULT)
    want = quality_rules.ledger(odd).filter(F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0).count()
    assert kept.count() == want > 0


def test_rules_on_nothing(nothing):
    assert quality_rules.ledger(nothing).count() == 0
    assert quality_rules.ablations(quality_rules.ledger(nothing)).count() == 0


def exact_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[brute.norm(r["text"])].append(r)
    return groups


def best(group):
    return min(group, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))


@pytest.mark.parametrize("digest", [exact_dedup.sha256_digest, lambda norm: F.unhex(F.substring(F.sha2(norm, 256), 1, 1).cast("string"))],
                         ids=["sha256", "four_bits"])
def test_exact_dedup(odd, digest):
    groups = exact_groups(odd.collect())
    want = sorted((str(r["doc_id"]), str(best(g)["doc_id"]), len(g)) for g in groups.values() for r in g)
    got = exact_dedup.assign(odd, salts=3, digest=digest).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(best(g)["doc_id"]) for g in groups.values())
    rows = exact_dedup.deduplicate(odd, salts=3, digest=digest).collect()
    assert sorted(str(r["text"] or "") for r in rows) == sorted(str(best(g)["text"] or "") for g in groups.values())


def test_exact_dedup_keeps_columns(clashing, nothing):
    assert exact_dedup.deduplicate(clashing).columns == clashing.columns
    assert exact_dedup.deduplicate(nothing).count() == 0
    assert exact_dedup.assign(nothing).count() == 0


def test_exact_dedup_of_one_large_group(spark):
    docs = spark.range(30000).select((F.col("id") - 15000).alias("doc_id"), F.lit("same  text").alias("text"))
    rows = exact_dedup.text_classes(docs).collect()
    assert [(r["keep_id"], r["group_size"], r["keep_chars"]) for r in rows] == [(-15000, 30000, 10)]
