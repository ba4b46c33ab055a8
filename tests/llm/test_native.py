"""Secret scan, exact dedup, line dedup and mixing on odd rows, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import blocknames, lines, mixing, secrets
from tests.llm.conftest import DOCS

SPACE = " \t\n\x0b\x0c\r"


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block", [3, 64, 2048])
def test_exact_groups(odd, block):
    groups = defaultdict(list)
    for i, t, *_ in DOCS:
        groups[low(t)].append(i)
    want, seen = [], Counter()
    for i, t, *_ in DOCS:
        own = groups[low(t)]
        keep = max((x for x in own if x is not None), default=None)
        seen[i, low(t)] += 1
        want.append((i, keep, len(own), i == keep and seen[i, low(t)] == 1, hashlib.sha256(low(t).encode()).hexdigest()))
    docs = odd if block > 3 else odd.filter("doc_id IS NULL OR doc_id NOT IN (6, 7)")
    want = want if block > 3 else [w for w in want if w[0] not in (6, 7)]
    assert rows(blocknames.exact_groups(docs, block_bytes=block).drop("copy")) == sorted(want, key=str)


def test_drop_copies_keeps_columns_and_one_row_each(odd, none):
    kept = blocknames.drop_copies(odd)
    assert kept.columns == odd.columns
    texts = [low(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({low(t) for _, t, *_ in DOCS})
    assert {r["doc_id"] for r in kept.collect()} >= {2, 7, 5, 10} and blocknames.drop_copies(none).count() == 0
    assert blocknames.exact_groups(none).count() == 0


def test_colliding_hashes_draw_new_seeds(odd, monkeypatch):
    real, seeds = blocknames._hash, []

    def weak(c, seed):
        seeds.append(seed)
        return real(c, seed) if seed > 1 else F.struct((F.octet_length(c) % 3).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))

    want = rows(blocknames.exact_groups(odd))
    monkeypatch.setattr(blocknames, "_hash", weak)
    assert rows(blocknames.exact_groups(odd)) == want and max(seeds) == 2


@pytest.mark.parametrize("chars", [1, 12])
def test_lines(odd, none, chars):
    key = lambda x: low(x.strip(SPACE))
    docs_of = defaultdict(set)
    for i, t, *_ in DOCS:
        for x in (t or "").split("\n"):
            if len(key(x)) >= chars:
                docs_of[key(x)].add(i)
    want = []
    for i, t, *_ in DOCS:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(docs_of[key(x)]) < 10]
        want.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    assert rows(lines.dedup_lines(odd, min_chars=chars)) == sorted(want, key=str)
    assert lines.dedup_lines(none).count() == 0


def spans(t, rules):
    found = []
    for rank, r in enumerate(rules):
        for m in re.finditer(r.pattern, t or ""):
            if len(m.group(r.group)) >= r.least:
                found.append((m.start(), rank, r.kind, m.end()))
    return sorted(found)


def test_secrets(odd, none):
    rules = secrets.BASE + secrets.MORE
    found, _ = secrets.scan_secrets(odd)
    got = sorted([(r["doc_id"], [tuple(s) for s in r["spans"]], [tuple(s) for s in r["base_spans"]]) for r in found.collect()], key=str)
    want = sorted([(i, spans(t, rules), [s for s in spans(t, rules) if s[1] < 3]) for i, t, *_ in DOCS], key=str)
    assert got == want and sum(len(s) for _, s, _ in got) >= 5
    assert secrets.scan_secrets(none)[0].count() == 0


def test_ledger_scans_only_unseen_pairs(spark, odd, monkeypatch):
    early = odd.filter("doc_id < 11")
    first, ledger = secrets.scan_secrets(early, rules=secrets.BASE)
    todo = []
    real = secrets._todo
    monkeypatch.setattr(secrets, "_todo", lambda *a: todo.append(real(*a)) or todo[-1])
    newer = (secrets.Rule("access", 2, "AKIA[A-Z0-9]{8,}"), *secrets.BASE[::2], *secrets.MORE)
    found, after = secrets.scan_secrets(odd, ledger, rules=newer)
    seen = {bytes(r["sha"]) for r in ledger.collect()}
    for r in todo[0].collect():
        assert set(r["rules"]) == ({"access", "private_key", "signed_token"} if bytes(r["sha"]) in seen else {x.kind for x in newer})
    assert rows(found) == rows(secrets.scan_secrets(odd, rules=newer)[0])
    again, last = secrets.scan_secrets(odd, after, rules=newer)
    assert todo[1].count() > 0 and todo[2].count() == 0
    assert rows(again) == rows(found) and last.count() == after.count()
    assert after.groupBy("sha", "rule", "version").count().filter("count > 1").count() == 0


def mixed(docs, target):
    """Plain Python for mix_counts."""
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    cell = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    own, count = Counter(), Counter()
    for i, t, _, s in docs:
        own[s] += words(t)
        count[s] += 1
    total = sum(own.values())
    share = {s: n / total for s, n in own.items() if n}
    weights = lambda a: {s: p**a / sum(q**a for q in share.values()) for s, p in share.items()}
    entropy = lambda w: -sum(x * math.log(x) for x in w.values())
    budget_of = lambda w: target.budget * total if target.budget else max(own[s] / w[s] for s in w)
    low, high = 0, 2**mixing.STEPS
    while high - low > 1:
        w = weights((mid := (low + high) // 2) / 2**mixing.STEPS)
        if target.entropy is not None:
            start = entropy(weights(1))
            good = entropy(w) >= start + target.entropy * (math.log(len(share)) - start)
            low, high = (mid, high) if good else (low, mid)
        else:
            good = max(budget_of(w) * w[s] / own[s] for s in w) <= target.repeats
            low, high = (low, mid) if good else (mid, high)
    w = weights((low if target.entropy is not None else high) / 2**mixing.STEPS)
    budget = math.floor(budget_of(w)) if target.budget else budget_of(w)
    out = []
    for s in own:
        members = [(i, words(t), cell(i)) for i, t, _, x in docs if x == s]
        blocks = 2 ** math.ceil(math.log2(max(1, count[s] / target.block_docs)))
        passes, rest = divmod(math.floor(w[s] * budget + 1e-6), own[s]) if own[s] else (1, 0)
        sizes = Counter()
        for _, n, c in members:
            sizes[c % blocks] += n
        order = sorted(sizes, key=lambda b: hashlib.md5(f"{target.seed}:{passes}:{s or ''}:{b}".encode()).hexdigest())
        upto, copies = 0, {}
        for b in order:
            upto += sizes[b]
            copies[b] = passes + (rest > 0 and 2 * upto - sizes[b] <= 2 * rest)
        out += [(i, s, n, round(w.get(s, 0.0), 9), c % blocks, order.index(c % blocks) + 1, copies[c % blocks]) for i, n, c in members]
    return sorted(out, key=str)


@pytest.mark.parametrize(
    "target",
    [mixing.Target(entropy=0.5, budget=1.0, block_docs=2), mixing.Target(repeats=3.0, block_docs=2), mixing.Target(repeats=1e9, budget=2.5, block_docs=1), mixing.Target(entropy=0.0)],
)
def test_mixing(odd, target):
    got = mixing.mix_counts(odd, target).withColumn("weight", F.round("weight", 9))
    assert rows(got) == mixed(DOCS, target)


@pytest.mark.parametrize("least", [1, 64])
def test_mixing_has_blocks_of_one_size_in_a_source_of_any_size(spark, monkeypatch, least):
    """One source of most rows: as many cells as it has blocks, whatever their least number, and many blocks in a lane."""
    monkeypatch.setattr(mixing, "CELLS", least)
    docs = [(i, "w " * (i % 7), None, "big" if i % 10 else None) for i in range(9000)]
    target = mixing.Target(entropy=0.3, budget=0.7, block_docs=1)
    got = mixing.mix_counts(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), target)
    assert rows(got.withColumn("weight", F.round("weight", 9))) == mixed(docs, target)
    assert got.filter("source = 'big'").agg(F.max("block")).first()[0] > 4096


def test_mix_repeats_rows_and_keeps_all_without_a_budget(odd, none):
    target = mixing.Target(repeats=3.0, block_docs=2)
    out = mixing.mix(odd, target)
    assert out.columns == odd.columns
    want = Counter()
    for i, _, n, *_, copies in mixed(DOCS, target):
        want[i] += copies
    assert Counter(r["doc_id"] for r in out.collect()) == want and min(want.values()) >= 1 and max(want.values()) > 1
    assert mixing.mix(none, target).count() == 0 and mixing.mix_counts(none, target).count() == 0


def test_native_operators_run_no_python(odd):
    for df in (blocknames.drop_copies(odd), lines.dedup_lines(odd), secrets.scan_secrets(odd)[0], mixing.mix(odd, mixing.Target(repeats=2.0))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
