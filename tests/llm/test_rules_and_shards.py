import brute
from haulage.llm.hostrules import COUNTS, beta_prior, judge, keep_good
from haulage.llm.sharding import fill, place, write_shards


def test_base_rules_against_brute_force(clashing, rows):
    rows = rows + [(50, "a b c d e f g h " * 4, None, None, 0), (51, "a b c d e f g h i a b c d e f g h " + "x y z " * 9, None, None, 0)]
    out = judge(clashing(rows)).select("doc.doc_id", *COUNTS, "base_failed").collect()
    assert {tuple(r) for r in out} == {(r[0], *brute.rules(r[1])) for r in rows}


def good(i):
    return " ".join(f"w{i}_{k}" for k in range(30))


def test_hosts_are_judged_with_a_prior(frame):
    rows = [(i, good(i) if i % 10 else "bad", "", "good", 0) for i in range(100)]
    rows += [(100 + i, "bad" if i % 10 else good(i), "", "spam", 0) for i in range(100)]
    rows += [(200, "bad", "", "one", 0), (201, good(201), "", None, 0), (202, "bad", "", None, 0), (203, None, "", "good", 0)]
    rows += [(300 + i, good(300 + i) if i % 20 else "bad", "", f"h{i % 5}", 0) for i in range(100)]
    out = {r.doc_id: r for r in judge(frame(rows)).select("doc.doc_id", "host", "base_failed", "host_rate", "kept").collect()}
    assert len(out) == len(rows)
    assert not any(r.kept for r in out.values() if r.host == "spam")
    assert all(r.kept != r.base_failed for r in out.values() if r.host == "good")
    assert out[200].host_rate < 0.99 and out[201].kept
    kept = keep_good(frame(rows)).collect()
    assert {r.doc_id for r in kept} == {i for i, r in out.items() if r.kept} and kept[0].asDict().keys() == {
        "doc_id", "text", "lang", "source", "n_chars"}


def test_prior():
    a, b = beta_prior(0.2, 0.01)
    assert abs(a / (a + b) - 0.2) < 1e-12 and abs(a * b / ((a + b) ** 2 * (a + b + 1)) - 0.01) < 1e-12
    assert beta_prior(None, None) == (0.0, 10.0) and beta_prior(0.5, 0.25) == (5.0, 5.0) and beta_prior(0.3, 0.0)[0] == 3.0


def test_rules_on_an_empty_table(frame):
    assert judge(frame([])).count() == 0 and keep_good(frame([])).count() == 0


def test_table_is_even_and_steady():
    names = [f"s{i}" for i in range(13)]
    owner = fill(names, 1009)
    sizes = [owner.count(i) for i in range(13)]
    assert max(sizes) - min(sizes) <= 1
    fewer = fill(names[:-1], 1009)
    assert sum(a != b for a, b in zip(owner, fewer) if a != 12) < 0.2 * 1009


def test_placement(spark, clashing, frame, rows, tmp_path):
    rows = rows + [rows[5], (None, "no id", None, None, None)]
    placed = place(clashing(rows))
    out = placed.selectExpr("doc.doc_id", "shard").collect()
    assert len(out) == len(rows) and len({(r.doc_id, r.shard) for r in out}) == len(rows) - 1
    write_shards(place(frame(rows)), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert place(frame([])).count() == 0
