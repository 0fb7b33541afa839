"""Base spans against plain regular expressions; what the method adds; odd inputs."""

import random
import re

from flowspark.llm.pii import KINDS, candidates, find_pii, fit, luhn


def base_spans(text):
    """(start, kind, end) by the patterns as they are stated."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    parts = ["a", "b.", "@", "@", "ex.com", ".", "1", "23", "255", "256", " ", "-", "+", "(", "é", "4539578763621486", "+1 (974) 555-3436", "1.2.3.4", "00255"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        assert sorted((a, KINDS.index(k), b) for k, a, b, p in candidates(text) if p == 2) == base_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1( " * 50_000, "a@" * 100_000):
        list(candidates(text))


def test_labelers_that_agree_win():
    good, bad = 2 * 27 + 2 * 9 + 2 * 3 + 2, 0
    scores = fit({("phone", good): 50, ("phone", bad): 50})
    assert scores["phone", good] > 0.9 and scores["phone", bad] < 0.1
    assert fit({}) == {}


def test_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (None, "mail a@b.com"), (4, "x " * 50_000 + "a@b.com"), (4, "x " * 50_000 + "a@b.com"), (5, "call (555) 555-0101 now"), (6, "é 1.2.3.4")]
    got = find_pii(docs(rows)).collect()
    assert len(got) == len(rows)
    spans = {}
    for r in got:
        spans.setdefault(r.doc_id, []).append([(s.kind, s.start, s.end) for s in r.spans if s.base])
    assert spans[1] == [[]] and spans[2] == [[]] and spans[None] == [[("email", 5, 12)]]
    assert spans[4] == [[("email", 100_000, 100_007)]] * 2 and spans[6] == [[("ip", 2, 9)]]
    assert find_pii(docs([])).collect() == []


def test_other_spellings_are_added(docs):
    rows = [(i, f"please call (974) 555-{i:04d} or call +1 (974) 555-{i:04d} today, mail me@site.com") for i in range(200)]
    got = find_pii(docs(rows)).collect()
    assert all(sum(s.kind == "phone" for s in r.spans) == 2 for r in got)
    assert all(sum(s.base for s in r.spans) == 2 for r in got)
