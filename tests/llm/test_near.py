"""What the near-duplicates of the pipeline leave on disk, and what they compare."""

import random
import time

from mereflow import scratch
from mereflow.llm import simhash
from pyspark.sql import functions as F


def test_saved_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        return {name for k in range(found.size()) if (name := found.apply(k).getName()).startswith("shuffle_")}

    before = shuffled()
    held = spark.conf.get(scratch.CLEANUP, "false")
    out = scratch.save(spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).count(), "grouped")
    assert spark.conf.get(scratch.CLEANUP, "false") == held
    out = scratch.save(out.join(spark.range(5_000).withColumnRenamed("id", "k").hint("merge"), "k"), "joined")
    most = time.time() + 20
    while (left := shuffled() - before) and time.time() < most:
        time.sleep(0.2)
    assert not left
    assert out.groupBy().sum("count").first()[0] == 20_000


def test_texts_that_share_a_passage_are_not_compared(spark, monkeypatch):
    """Of texts of 226 shingles the first 46 are looked at; at least 20 of them have to be shared, a passage has about five."""
    rng = random.Random(3)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = text(30)
    rows = [(k, " ".join([*text(100), *passage, *text(100)])) for k in range(60)]
    # the same shingles but few, whose words are in other orders: fingerprints of words do not tell them apart, sets do
    words = rows[0][1].split()
    rows += [(100, " ".join(words[:-1])), (101, " ".join(words[1:] + ["new"]))]
    asked = []

    def alike(pairs, sets, similarity, own=simhash._alike):
        asked.append(pairs.count())
        return own(pairs, sets, similarity)

    monkeypatch.setattr(simhash, "_alike", alike)
    signs, rooted = simhash.similar(spark.createDataFrame(rows, "doc_id long, text string"))
    root = {r.sig: r.root.doc_id for r in rooted.collect()}
    assert {r.doc_id: root[r.sig] for r in signs.collect()} == {k: k if k < 60 else 0 for k, _ in rows}
    assert sum(asked) < 100


def test_first_shingles_of_noted_ones(spark):
    """From the smallest hashes of a set come the same first shingles as from all of it, or it is said that they do not suffice."""
    rng = random.Random(6)
    own = {k: sorted(rng.sample(range(-900, 900), rng.randrange(1, 300))) for k in range(40)}
    crowds = spark.createDataFrame([(t, 70 + t % 3) for t in range(-900, -700)] + [(t, 90) for t in range(-700, 900, 9)], "token long, c long")
    full = spark.createDataFrame(list(own.items()), "sig long, hashes array<long>")
    part = spark.createDataFrame([(k, len(x), x[: simhash._noted(len(x), 0.8)]) for k, x in own.items()], "sig long, n long, hashes array<long>")
    for listed in (10_000, 0):
        want = {r.sig: (r.n, r.low, r.deep) for r in simhash._by_rarity(full, crowds, 0.8, listed).collect()}
        got = simhash._by_rarity(part, crowds, 0.8, listed).collect()
        assert {r.sig for r in got} == set(own) and 0 < sum(r.whole for r in got) < len(own)
        assert all((r.n, r.low, r.deep) == want[r.sig] for r in got if r.whole)
