"""Rules, personal data, classifiers on held-out rows, sharding and mixing."""

import random
import re
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.llm.pii import find_spans, luhn, mod97
from strata.llm.rules import Rule, quality_rules
from strata.llm.sharding import kd_shards, write_shards
from strata.llm.toxicity import Presence, choose_words, fit_nnpu, fit_toxicity, nnpu_risk, toxicity_scores


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def auc(labels, scores):
    """How often a text of class 1 is scored above one of class 0; ties count half."""
    a, b = scores[labels == 1], scores[labels == 0]
    return ((a[:, None] > b).mean() + (a[:, None] >= b).mean()) / 2


@pytest.mark.parametrize("name, label, least", [("op4_compression_quality", "quality", 0.85), ("op8_toxicity", "toxic", 0.75)])
def test_held_out(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    rows = entry.queries()[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == (rows["score"] >= 0.3)).all()
    assert auc(rows[label].to_numpy(), rows["score"].to_numpy()) >= least


def test_labels_of_held_out_rows_do_not_teach(spark, tmp_path):
    """Scores stay the same when the labels of all held-out rows are turned round."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    turned = labels.withColumn("quality", F.when(key % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn(
        "toxic", F.when(key % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    turned.write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op4_compression_quality", "op8_toxicity"):
        a, b = ({r.doc_id: r.score for r in entry.queries()[name](spark, d).collect()} for d in (folder, str(tmp_path)))
        assert a == pytest.approx(b)


def test_nnpu_finds_the_marked_texts():
    rng = random.Random(2)
    text = lambda toxic: " ".join([f"w{rng.randrange(300)}" for _ in range(40)] + ["badword"] * toxic)
    model = fit_nnpu([text(1) for _ in range(200)], [text(int(rng.random() < 0.1)) for _ in range(1000)], 0.1)
    assert model.score(text(1)) > 0.7 and model.score(text(0)) < 0.1 and 0 <= model.score("") < 0.3


def test_words_of_a_small_share_are_features_at_any_size():
    for times in (1, 10):
        toxic = (["the rare insult"] * 4 + ["the common slur"] * 56) * times
        assert {"insult", "slur"} <= {w.rstrip("-") for w in choose_words(toxic, ["the plain words"] * 300 * times)}


def test_nnpu_risk_and_slope():
    """Against dense matrices and finite differences, on both sides of zero."""
    rng = np.random.default_rng(3)
    seen = set()
    for _ in range(30):
        dense = [(rng.random((n, 6)) < 0.4).astype(float) for n in (8, 15)]
        p, u = (Presence.of([np.flatnonzero(r).tolist() for r in x]) for x in dense)
        prior, w = rng.uniform(0.1, 0.9), rng.normal(size=7) * 2

        def parts(w):
            zp, zu = (x @ w[:6] + w[6] for x in dense)
            loss = lambda z: np.log1p(np.exp(z)).mean()
            return prior * loss(-zp), loss(zu) - prior * loss(zp), 0.5 * 0.01 * (w[:6] ** 2).sum()

        def goal(w):
            plus, minus, ridge = parts(w)
            return (plus + minus if negative >= 0 else -minus) + ridge

        risk, negative, slope = nnpu_risk(p, u, w, prior, 0.01)
        plus, minus, ridge = parts(w)
        assert negative == pytest.approx(minus) and risk == pytest.approx(plus + max(0, minus) + ridge)
        seen.add(negative >= 0)
        steps = np.eye(7) * 1e-6
        assert slope == pytest.approx([(goal(w + d) - goal(w - d)) / 2e-6 for d in steps], abs=1e-5)
    assert seen == {True, False}


def test_no_evidence_is_not_toxic_whatever_the_labels(spark):
    rng = random.Random(8)
    plain = lambda: " ".join(f"word{rng.randrange(200)}" for _ in range(30))
    rows = [(i, plain() + (" vileslur" if i % 5 < 2 else ""), int(i % 5 < 2)) for i in range(200)] + [(500, "", None), (501, None, None), (502, plain(), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scores = {r.doc_id: r.score for r in toxicity_scores(docs, fit_toxicity(docs, docs.select("doc_id", "toxic"), F.lit(True))).collect()}
    assert all((scores[i] >= 0.3) == (i % 5 < 2) for i in range(200)) and max(scores[500], scores[501], scores[502]) <= 0.2
    none = fit_toxicity(docs, docs.select("doc_id", F.lit(0).alias("toxic")), F.lit(True))
    every = fit_toxicity(docs, docs.select("doc_id", F.lit(1).alias("toxic")), F.lit(True))
    assert none.score("anything") <= 0.2 and every.score("") <= 0.2


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m, d: 13 <= len(d) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
}


def test_base_spans_are_the_regular_expressions():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice(rng.choice(["a@.b-1 2+(0é", "0123456789 -+.4 1@a", "4 0"])) for _ in range(rng.randrange(40)))
        want = [(k, *m.span()) for k, (p, ok) in BASE.items() for m in re.finditer(p, text) if ok(m[0], re.sub("[^0-9]", "", m[0]))]
        assert [s[:3] for s in find_spans(text) if s[4]] == want


def test_added_spans():
    assert mod97("DE89370400440532013000") and not mod97("DE88370400440532013000") and luhn("4111111111111111")
    kinds = lambda t: [s[0] for s in find_spans(t) if not s[4]]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00.") == ["iban"] and kinds("DE88 3704 0044 0532 0130 00") == []
    assert kinds("social security 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == [] and kinds("ssn 000-45-6789") == []
    assert find_spans("9" * 100_000) == find_spans("") == []


def test_account_numbers_before_other_words():
    spans = lambda t: [t[s[1] : s[2]] for s in find_spans(t) if s[0] == "iban"]
    german, british = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    assert spans(f"IBAN {german} BIC COBADEFFXXX") == [german] and spans(f"{german} {british} I") == [german, british]
    assert spans("DE89370400440532013000 2 payments") == ["DE89370400440532013000"]
    assert spans("GB82WEST12345698765432 I confirm") == ["GB82WEST12345698765432"] and spans(f"REF AB12 3456 {german} OK") == [german]


def test_address_with_many_zeros():
    assert [s[0] for s in find_spans("0" * 5000 + ".0.0." + "0" * 5000 + "1") if s[0] == "ip"] == ["ip"]


def test_rules_are_a_table(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat and " * 10), (2, "### " * 60)], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality_rules(docs, [Rule("symbols", "symbols_per_word", high=1.0)]).collect()}
    assert rows[1].failed_rules == [] and rows[2].failed_rules == ["symbols"] and rows[2].n_symbols == 180
    assert rows[1].n_words == 70 and rows[1].n_repeat_words == 70 and rows[1].base_failed


def test_rules_run_no_python(spark, plan):
    text = plan(quality_rules(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))))
    assert not re.search("Python|Arrow|Pandas|Exchange", text)


@pytest.mark.parametrize("leaves", [1, 2, 7, 40])
def test_shards(spark, tmp_path, leaves):
    rng = random.Random(leaves)
    rows = [(i, "x" * rng.choice([0, 5, 90, 400, 2000]), rng.choice("aaaaab"), rng.randrange(10**12)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, big long")
    out = kd_shards(docs, ["source", "big"], leaves=leaves)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in out.collect():
        sizes[r.shard] += len(r.text) + 16
        slots[r.shard].append(r.slot)
    assert sorted(sizes) == list(range(leaves))
    assert max(sizes.values()) - min(sizes.values()) <= 6 * 2016
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if leaves == 7:
        write_shards(out, f"{tmp_path}/out")
        back = spark.read.parquet(f"{tmp_path}/out")
        assert back.count() == 1500 and back.select("shard").distinct().count() == 7


def plain_tree(rows, leaves, whole=None):
    """The same recursion on lists of (codes per dimension, measures per dimension, size, id): id -> shard."""
    whole = whole or [(min(r[1][d] for r in rows), max(r[1][d] for r in rows)) for d in range(len(rows[0][1]))]
    if leaves == 1:
        return [rows]
    width = [(max(r[1][d] for r in rows) - min(r[1][d] for r in rows)) / ((whole[d][1] - whole[d][0]) or 1.0) for d in range(len(whole))]
    dim = width.index(max(width))
    total, left = sum(r[2] for r in rows), leaves // 2
    goal, run = total * left / leaves, 0
    groups = defaultdict(list)
    for r in rows:
        groups[r[0][dim]].append(r)
    for key in sorted(groups):
        here = sum(r[2] for r in groups[key])
        if run + here >= goal or key == max(groups):
            low = [r for k in groups if k < key for r in groups[k]]
            if 2 * (goal - run) >= here:
                low += groups[key]
            break
        run += here
    high = [r for r in rows if r not in low]
    both = ((low, left), (high, leaves - left))
    return [shard for part, n in both for shard in (plain_tree(part, n, whole) if part else [[]] * n)]


@pytest.mark.parametrize("kind", ["plain", "text", "hash", "decimal", "fraction", "long text"])
def test_shards_are_those_of_a_plain_tree(spark, kind):
    """Ids and dimensions of any type are cut at their full values: shard by shard against the recursion in plain Python."""
    rng = random.Random(kind)
    n, same = 240, "x" * 70
    ids = {
        "plain": list(range(n)), "text": [f"doc-{i:08d}" for i in range(n)], "hash": [rng.randrange(-(2**63), 2**63) for _ in range(n)],
        "decimal": list(range(n)), "fraction": list(range(n)), "long text": [f"doc-{i:08d}" for i in range(n)],
    }[kind]
    dims = {
        "plain": [5] * n, "text": [rng.choice(["alphabetical", "alphabetica", "alpha", ""]) for _ in range(n)], "hash": [1] * n,
        "decimal": [rng.randrange(10**30) for _ in range(n)], "fraction": [rng.random() * 1e-3 for _ in range(n)], "long text": [same + str(i % 7) for i in range(n)],
    }[kind]
    types = {"plain": "long, d int", "text": "string, d string", "hash": "long, d int", "decimal": "long, d decimal(38,0)", "fraction": "long, d double", "long text": "string, d string"}
    rows = [(i, d if kind != "decimal" else Decimal(d), "y" * rng.choice([0, 30, 200])) for i, d in zip(ids, dims)]
    docs = spark.createDataFrame(rows, f"doc_id {types[kind]}, text string")
    out = kd_shards(docs, ["d"], leaves=8).collect()
    sizes = [sum(len(r.text) + 16 for r in out if r.shard == k) for k in range(8)]
    assert max(sizes) - min(sizes) <= 3 * 216
    if kind != "long text":
        padded = lambda t: tuple(t.encode().ljust(14, b"\0")[i : i + 7] for i in (0, 7))
        first = lambda d: float(int.from_bytes(d.encode()[:7].ljust(7, b"\0"), "big")) if kind == "text" else float(d)
        coded = [((((padded(d) if kind == "text" else (d,)), i),), (first(d),), len(t) + 16, i) for i, d, t in rows]
        want = {r[3]: k for k, shard in enumerate(plain_tree(coded, 8)) for r in shard}
        assert {r.doc_id: r.shard for r in out} == want
    for k in range(8):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))


def test_shards_by_bytes(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x" * 84).alias("text"))
    sizes = [r["n"] for r in kd_shards(docs, ["doc_id"], target_bytes=10_000).groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert sizes == [100] * 10


def test_mix_targets(spark):
    """Each source comes within one document of its target, reruns agree, and bins do not show."""
    from strata.llm.mixing import mix

    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a"] * 6 + ["b", "c", None])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = {r.doc_id: r for r in mix(docs).collect()}
    again = {r.doc_id: r.taken for r in mix(docs.repartition(5), bin_rows=10).collect()}
    assert again == {i: r.taken for i, r in first.items()}
    totals, size = defaultdict(int), {}
    for r in first.values():
        totals[r.source] += r.taken
        size[r.source] = (r.source_size, r.target)
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert sum(t for _, t in size.values()) == pytest.approx(1.5 * sum(s for s, _ in size.values()))
    for source, (whole, target) in size.items():
        assert target <= 2 * whole + 1e-6 and abs(totals[source] - target) <= 30.5


def test_mix_prefers_quality(spark):
    from strata.llm.mixing import mix

    docs = spark.createDataFrame([(i, "a b c d", i % 2) for i in range(2000)], "doc_id long, text string, good int").withColumn("source", F.lit("s"))
    taken = mix(docs, share=0.5, quality=F.when(F.col("good") == 1, 4.0).otherwise(1.0)).groupBy("good").agg(F.sum("taken").alias("t")).collect()
    by = {r.good: r.t for r in taken}
    assert by[1] > 1.8 * by[0]


def test_mix_draws_rows_without_an_id_one_by_one(spark):
    from strata.llm.mixing import mix

    docs = spark.createDataFrame([(None, f"a b c {i:03d}", "s") for i in range(400)], "doc_id long, text string, source string")
    taken = [r.taken > 0 for r in mix(docs, share=0.5, quality=F.when(F.substring("text", 7, 3) < "200", 1.0).otherwise(1.001)).sort("text").collect()]
    assert 50 < sum(taken[:200]) < 150
