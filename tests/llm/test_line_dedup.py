import re
import time
from collections import defaultdict

from pagesieve.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))


def brute(pairs):
    found = defaultdict(set)
    for i, text in pairs:
        for line in (text or "").split("\n"):
            if i is not None and len(key_of(line)) >= 20:
                found[key_of(line)].add(i)
    out = []
    for i, text in pairs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(found.get(key_of(x), ())) < 3 or max(found[key_of(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(df, **kw):
    out = line_dedup.dedup_lines(df, **kw)
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()], key=str)


def test_against_brute_force(frame, rng):
    pool = [f"Line number {i} that is long enough" for i in range(30)] + ["short", "", "  short  ", "ÀÉ" * 12]
    pairs = []
    for i in range(200):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 8))]
        lines = [x.upper() if rng.random() < 0.2 else f" \t{x}\r" if rng.random() < 0.2 else x for x in lines]
        pairs.append((i, "\n".join(lines)))
    want = brute(pairs)
    assert any(r[2] for r in want)
    for batches, fan_in in ((1, 2), (4, 2), (7, 3)):
        assert run(frame(pairs), batches=batches, fan_in=fan_in) == want


def test_odd_rows(frame, odd_pairs):
    assert run(frame(odd_pairs)) == brute(odd_pairs)


def test_hot_line_and_length_limit(frame):
    pairs = [(i, "x" * 20 + f"\nown line of document {i}\n" + "y" * 19) for i in range(300)]
    got = run(frame(pairs))
    assert got == brute(pairs)
    assert sum(r[2] for r in got) == 299  # the largest id keeps it; 19 code points are too few


def test_empty_table(frame):
    assert run(frame([])) == []


def test_batch_anti_join_returns_new_lines_only(frame):
    levels = line_dedup.Levels(fan_in=2)
    seen = set()
    for k in range(5):
        pairs = [(100 - k, "\n".join(f"a common line of batches {j:03d}" for j in range(k + 3)))]
        lines = line_dedup.document_lines(frame(pairs).select("doc_id", "text"))
        fresh = {(r.a, r.b) for r in line_dedup.append_batch(levels, lines).collect()}
        assert not fresh & seen and len(fresh) == (3 if k == 0 else 1)
        seen |= fresh
    assert len(levels.runs()) == 2  # five runs: one of four batches, one of one
    merged = line_dedup.merge_runs(levels.runs()).collect()
    assert len(merged) == 7 and max(r.docs for r in merged) == 5 and {r.keeper for r in merged} <= set(range(96, 101))


def test_no_python_on_the_main_path(frame, capsys):
    line_dedup.dedup_lines(frame([(1, "a"), (2, "b")])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_very_many_lines_in_one_document(frame):
    """Linear in a document's lines: quadratic marking took minutes here."""
    lines = [f"the line number {i} of a very long document" for i in range(200_000)]
    shared = lines[::2]
    pairs = [(1, "\n".join(lines)), (2, "\n".join(shared)), (3, "\n".join(shared) + "\nend"), (3, "short")]
    start = time.time()
    got = run(frame(pairs))
    assert time.time() - start < 60
    assert got == brute(pairs)
    assert got[0][2] == 100_000


def test_anti_joins_move_no_row(spark, frame):
    docs = frame([(i, f"a line of some length {i % 7}\nand another one of {i % 3}") for i in range(60)])
    lines = line_dedup.document_lines(docs.select("doc_id", "text"))
    levels = line_dedup.Levels(4)
    for part in line_dedup.descending_batches(lines, 3)[:2]:
        line_dedup.append_batch(levels, lines.where(part))
    one, two = levels.runs()
    joined = one.select("a", "b").join(two.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
