from collections import Counter

from cellstar.llm import quality_rules as qr
from cellstar.llm import registry

GOOD = "\n".join(
    f"Line{i} says{i} something{i} about{i} topic{i} in{i} plain{i} words{i}." for i in range(12))


def test_repeat_words_against_brute_force():
    import random
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 25))]
        seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
        assert qr.repeat_words(words) == len(covered)


def test_lines():
    n, chars, symbols, dup, repeats, failed, kept, lines, bad, text = qr.judge(GOOD)
    assert (failed, kept, bad, dup, text) == (False, True, 0, 0, GOOD)
    assert not qr.line_passes("Home | News | Sport | About", 7)
    assert not qr.line_passes("We use cookies to make this better.", 7)
    assert not qr.line_passes("Contact us", 2)
    assert not qr.line_passes("this### that*** more$$$ words&&&", 4)
    assert qr.line_passes("Done.", 1) and qr.line_passes("", 0)


def test_duplicate_lines_and_base():
    out = qr.judge(GOOD + "\n" + GOOD)
    assert out[3] == 12 and out[5]            # every word stands in a repeated window
    assert qr.judge("")[:9] == (0, 0, 0, 0, 0, True, False, 0, 0)
    junk = "\n".join(f"alpha{i}### beta{i}*** gamma{i}$$$ delta{i}&&& eps{i}%%%" for i in range(30))
    assert qr.judge(junk)[5:7] == (False, False)


def test_sql(spark, duck):
    """The registered query equals its SQL on the smallest tables."""
    got = registry.QUERIES["op3_quality_rules"](spark, "/root/testdata/sf0.001")
    want = duck.sql(registry.ORACLES["op3_quality_rules"])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    rows = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert rows == sorted(want.project(", ".join(columns)).fetchall())
