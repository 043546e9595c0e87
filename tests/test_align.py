from pyspark.sql import functions as F

from lexiflow.functions.text import instantiate
from lexiflow.operators import align as AL
from lexiflow.operators.windows import range_chunks


def test_best_alignment_costs_and_ties():
    a, b, c = AL.best_alignment("walked", "walk")
    assert (a, b, c) == ("walked", "walk~~", 2.0)
    a, b, c = AL.best_alignment("", "ab")
    assert (a, b, c) == ("~~", "ab", 2.0)
    a, b, c = AL.best_alignment("kitten", "sitting")
    assert c == 3.0 and a.replace("~", "") == "kitten" and b.replace("~", "") == "sitting"


def test_action_sequence_worked_example(spark):
    rows = [("~~~yūnāniyyun", "al-yūnāniyyi~"), ("kalb~~", "kalber"), ("", ""), ("~~", "ab"), ("ab~", "abb")]
    df = spark.createDataFrame(rows, "a string, b string")
    acts = [r.x for r in df.select(AL.actions(F.col("a"), F.col("b")).alias("x")).collect()]
    # prefix insertion, copies, a substitution and a deletion at the end
    assert acts[0][:5] == ["a", "l", "-", "^", "1"] and acts[0][-4:] == ["i", "^", "^", ">"]
    assert acts[1] == ["^", "1", "^", "2", "^", "3", "^", "4", "e", "r", "^", ">"]
    assert acts[2:] == [[">"], ["a", "b", "^", ">"], ["^", "1", "^", "2", "2", "^", ">"]]


def test_template_reproduces_word(spark):
    pairs = spark.createDataFrame([("walk", "walked"), ("sing", "sang"), ("go", "went"), ("abc", "")],
                                  "source string, target string")
    al = AL.align_med(pairs)
    t = al.select("source", "target", AL.template(F.col("aligned_source"), F.col("aligned_target")).alias("t"))
    rows = t.select("target", instantiate(F.col("t"), F.col("source")).alias("w")).collect()
    assert all(r.target == r.w for r in rows)


def test_corpus_alignment_keeps_strings(spark):
    pairs = spark.createDataFrame([("walk", "walked")] * 3 + [("talk", "talked"), ("sing", "sang")],
                                  "source string, target string")
    al = AL.align_corpus(pairs, iters=2).collect()
    assert len(al) == 3
    for r in al:
        assert r.aligned_source.replace("~", "") == r.source and r.aligned_target.replace("~", "") == r.target
        assert len(r.aligned_source) == len(r.aligned_target)


def _every_alignment(s, t):
    """All alignments of two strings, as lists of columns."""
    if not s and not t:
        return [[]]
    out = []
    if s:
        out += [[(s[0], "~"), *r] for r in _every_alignment(s[1:], t)]
    if t:
        out += [[("~", t[0]), *r] for r in _every_alignment(s, t[1:])]
    if s and t:
        out += [[(s[0], t[0]), *r] for r in _every_alignment(s[1:], t[1:])]
    return out


def test_corpus_costs_against_every_alignment(spark):
    words = [("abc", "abd"), ("abc", "ab"), ("ba", "bab"), ("", "a"), ("a", ""), ("", ""), ("cab", "cb"),
             ("abcd", "bcd"), ("dd", "ddd"), ("ac", "ca")]
    pairs = spark.createDataFrame(words + words[:3], "source string, target string")
    rounds = list(AL.corpus_rounds(pairs))
    assert len(rounds) > 2
    totals = []
    for counts, before, now in rounds[1:]:
        cost, tot = AL.costs_from_counts(counts)
        price = {(r.x, r.y): r.c for r in cost.collect()}
        other = tot.first()["default"]
        own = {(r.source, r.target): r.price for r in AL.column_prices(now, counts).collect()}
        old = {(r.source, r.target): r.price for r in AL.column_prices(before, counts).collect()}
        rows = now.collect()
        assert len(rows) == len(words) == len(own) == len(old)
        for r in rows:
            least = min(sum(price.get(c, other) for c in a) for a in _every_alignment(r.source, r.target))
            assert abs(r.cost - least) < 1e-9 and abs(own[r.source, r.target] - least) < 1e-9
            assert old[r.source, r.target] >= least - 1e-9
        totals.append((sum(r.n * old[r.source, r.target] for r in rows), sum(r.n * r.cost for r in rows)))
    assert all(now <= before + 1e-9 for before, now in totals)


def test_report_index_is_dense_and_in_order_under_one_prefix(spark):
    rows = [("prefix%04d" % (i * 7919 % 3000), "t") for i in range(3000)]
    al = spark.createDataFrame([(s, t, s, t) for s, t in rows], "source string, target string, aligned_source string, aligned_target string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        sizes = range_chunks(al, ["source", "target"]).groupBy("_range").count().collect()
        got = AL.alignment_report(al).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 1500  # one prefix, many tasks
    assert [r.aligned_source for r in sorted(got, key=lambda r: r["index"])] == sorted(s for s, _ in rows)
    assert sorted(r["index"] for r in got) == list(range(1, 3001))
