"""Fingerprint components, the prefix trie and term shares against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from recueil.llm import divergence, rolling, simhash, trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# ------------------------------------------------------------ fingerprints

DOCS = "doc_id BIGINT, text STRING, fp STRING, component STRING, fingerprint STRING, component_id BIGINT, lang STRING, source STRING"


def docs(spark, rows):
    """Rows with further columns whose names clash with results."""
    return spark.createDataFrame([(i, x, "f", "c", "g", -5, lang, source) for i, x, lang, source in rows], DOCS)


def some_docs():
    dice = random.Random(11)
    words = [a + b for a in ("ba", "Ko", "ré", "ti", "LU") for b in ("na", "so", "mi", "ß", "dor")]

    def prose(n):
        return [dice.choice(words) + dice.choice(words) for _ in range(n)]

    base = [prose(dice.choice([1, 3, 4, 9, 80, 300])) for _ in range(25)]
    texts = [" ".join(x) for x in base] + [" ".join(base[4]).upper(), " \n".join(base[4])]
    for i in range(60):  # near copies, more and less far
        near = list(base[dice.randrange(20, 25)] or base[0])
        for _ in range(dice.randint(0, 4)):
            near[dice.randrange(len(near))] = "x" + str(dice.random())
        texts.append(" ".join(near))
    texts += ["", " \t\n", None, "", "one", "ONE", "a\x0bb c d", " ".join(prose(9000))]
    rows = [(i, x, dice.choice(["fr", "en", None]), dice.choice(["s", "t", "", None])) for i, x in enumerate(texts)]
    return rows + [(None, "no id", "fr", "s"), (None, None, "", ""), (7, "twice seven", "en", "t"), (7, "twice seven", "en", "t")]


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    n = max(1, len(words) - 3) if words else 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_simhash(rows):
    prints = [brute_print(x) for _, x, *_ in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    lowest = {}
    for (i, *_), x in zip(rows, label, strict=True):
        if i is not None:
            lowest[x] = min(lowest.get(x, i), i)
    return Counter((i, f"{p:016x}", lowest.get(x)) for (i, *_), p, x in zip(rows, prints, label, strict=True))


@pytest.mark.parametrize("block", [500, 3])
def test_fingerprint_components_are_those_of_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = some_docs()
    found = simhash.simhash_join(docs(spark, rows)).collect()
    assert Counter(map(tuple, found)) == brute_simhash(rows)


def some_prints(seed):
    dice = random.Random(seed)
    prints = {dice.getrandbits(64) for _ in range(20)} | {0}
    for _ in range(300):  # chains of changed bits, some short of a link
        x = dice.choice(sorted(prints))
        for b in dice.sample(range(64), dice.choice([1, 3, 4, 5, 6])):
            x ^= 1 << b
        prints.add(x)
    return np.array(sorted(prints), np.uint64)


@pytest.mark.parametrize("parts", simhash.PARTITIONS)
def test_every_number_of_partitions_finds_all_links(parts):
    numbers = some_prints(parts)
    bits = simhash._bits(numbers).astype(np.int64)
    dealt = simhash.partitioned(len(numbers), bits.T @ bits, parts)
    counts = [[np.bincount(simhash.values(numbers, p).astype(np.int64), minlength=1 << len(p)) for p in simhash._pieces(x)] for x in dealt]
    plan = simhash.Plan(dealt, counts)
    chosen, _ = plan.thresholds(numbers)
    own = [simhash.values(numbers, x) for x in dealt]
    for i, x in enumerate(numbers):
        found = np.zeros(len(numbers), bool)
        for part in range(parts):
            for k in range(chosen[i, part] + 1):
                found |= np.isin(own[part], own[part][i] ^ plan.masks[part][k])
        near = np.bitwise_count(numbers ^ x) <= simhash.REACH
        assert found[near].all()


def test_chains_of_fingerprints_are_one_component(spark):
    numbers = some_prints(9)
    label = list(range(len(numbers)))
    for i in range(len(numbers)):
        for j in np.flatnonzero(np.bitwise_count(numbers[i] ^ numbers[:i]) <= simhash.REACH):
            old, new = label[i], label[int(j)]
            label = [new if x == old else x for x in label]
    table = spark.createDataFrame([(int(x),) for x in numbers.view(np.int64)], "fp BIGINT")
    groups, by_component = defaultdict(set), defaultdict(set)
    for x, name in zip(numbers.view(np.int64).tolist(), label, strict=True):
        groups[name].add(x)
    for row in simhash.fingerprint_components(table).collect():
        by_component[row["component"]].add(row["fp"])
    assert sorted(map(sorted, by_component.values())) == sorted(map(sorted, groups.values()))


def test_thresholds_follow_the_counts():
    dice = np.random.default_rng(3)
    numbers = dice.integers(0, 1 << 63, 4000).astype(np.uint64)
    numbers[:3000] &= ~np.uint64(0xFFFF)  # sixteen bits that say nothing for most
    parts = [list(range(16 * i, 16 * i + 16)) for i in range(4)]
    counts = [[np.bincount(simhash.values(numbers, p).astype(np.int64), minlength=1 << len(p)) for p in simhash._pieces(x)] for x in parts]
    plan = simhash.Plan(parts, counts)
    chosen, cost = plan.thresholds(numbers)
    assert (chosen.sum(axis=1) == simhash.REACH - 4 + 1).all() and (cost > 0).all()
    # The part that many share is looked up less widely by them.
    assert (chosen[:3000, 0] < chosen[:3000].max(axis=1)).all()


def test_correlated_bits_share_a_partition():
    dice = np.random.default_rng(5)
    bits = dice.integers(0, 2, (3000, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 63] = 1 - bits[:, 17]
    both = bits.T @ bits
    for m in simhash.PARTITIONS:
        where = {b: i for i, part in enumerate(simhash.partitioned(3000, both, m)) for b in part}
        assert len(where) == 64 and where[3] == where[40] and where[17] == where[63]


# -------------------------------------------------------------------- trie

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, place STRING, depth STRING, ends BOOLEAN, fp STRING"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "p", "d", True, "f") for r in rows], TURNS)


def some_turns():
    dice = random.Random(4)
    rows = []
    for c in [*range(0, 30), *range(100, 112), *range(305, 320), 1200, -3, -100]:
        for turn in range(dice.choice([1, 2, 4, 5, 6, 9])):
            same = c < 20 and turn < 3
            rows.append((c, turn, "user" if turn % 2 else "assistant", f"turn {turn} é" if same else f"{c} said {turn}"))
    rows += [(400, t, "user", f"long {t}") for t in range(300)] + [(c, t, "user", "same") for c in (501, 502, 503) for t in range(8)]
    rows += [(600, None, None, "before"), (600, 3, None, None), (600, 3, "", None), (600, 3, "user", "tie"), (601, 1, "x", "y")]
    rows += [(700, 1, "user", "twice"), (700, 1, "user", "twice"), (None, 1, "user", "nobody")]
    dice.shuffle(rows)
    return rows


def brute_trie(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by[c].append((turn is not None, turn or 0, said, role, text))
    seqs = {c: [x[3:] for x in sorted(v)] for c, v in by.items()}
    rebuilt = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(seqs.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, line in rebuilt.items():
        for d in range(len(line) + 1):
            members[line[:d]].append(c)
    kids = defaultdict(set)
    for line in members:
        if line:
            kids[line[:-1]].add(line)
    leaves, saved = Counter(), Counter()
    for line, who in members.items():
        for d in range(len(line) + 1):
            leaves[line[:d]] += not kids[line]
            saved[line[:d]] += (len(who) - 1) * len(line[-1][1]) if line else 0
    out = Counter()
    for line, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(rebuilt[c]) == len(line)))
        above = min(members[line[:-1]]) if line else None
        out[min(who), len(line), above, len(who), len(kids[line]), leaves[line], saved[line], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def test_trie_is_that_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 2)
    rows = some_turns()
    assert Counter(map(tuple, trie.prefix_trie(turns(spark, rows)).collect())) == brute_trie(rows)


def test_a_conversation_over_several_ranges(spark):
    """Products of parts are composed, whatever the ranges are."""
    rows = [(5, t, "user", str(t)) for t in range(150)] + [(c, t, "user", "x") for c in (4, 6, 0) for t in range(7)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert Counter(map(tuple, trie.prefix_trie(turns(spark, rows)).collect())) == brute_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_collision_is_noticed_and_another_base_taken(spark):
    rows = [(c, t, "user", f"{c % 7} {t}") for c in range(20) for t in range(7)]
    # With this base only the first turns of a sequence count.
    found = trie.prefix_trie(turns(spark, rows), bases=(1, trie.BASES[0]))
    assert Counter(map(tuple, found.collect())) == brute_trie(rows)

    class Blind(trie.Monoid):
        def powers(self, n):
            return np.zeros(n + 1, np.uint64)

    before = trie.Monoid
    trie.Monoid = Blind
    try:
        with pytest.raises(RuntimeError, match="collide"):
            trie.prefix_trie(turns(spark, rows))
    finally:
        trie.Monoid = before


def test_sequences_are_a_monoid():
    monoid = trie.Monoid(trie.BASES[0])
    dice = random.Random(1)
    t = [dice.getrandbits(64) for _ in range(9)]

    def product(x):
        return sum(v * pow(monoid.base, i + 1, 1 << 64) for i, v in enumerate(x)) % (1 << 64)

    for cut in range(10):
        assert monoid.joined(product(t[:cut]), cut, product(t[cut:])) == product(t)
    assert monoid.base * monoid.inverse % (1 << 64) == 1


# ------------------------------------------------------------------ shares


def brute_divergence(rows):
    rows = [(x or "", lang or "", source or "") for _, x, lang, source in rows]
    words = [Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", x.translate(LOWER))) for x, *_ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        mine = [(w, s) for w, (_, x, s) in zip(words, rows, strict=True) if x == lang]
        df = Counter(t for w, _ in mine for t in w)
        kept = sorted(t for t, n in df.items() if n >= divergence.LEAST)
        groups = {s: Counter() for _, s in mine}
        for w, s in mine:
            groups[s].update({t: w[t] for t in kept if t in w})
        whole = sum(groups.values(), Counter())

        def share(c, t, v=len(kept)):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v)

        def differ(p, q):
            return (p - q) ** 2 // (p + q)

        for s, c in groups.items():
            pairs = [(-sum(differ(share(c, t), share(o, t)) for t in kept), b.encode()) for b, o in groups.items() if b != s]
            words_of = [(-differ(share(c, t), share(whole, t)), t.encode()) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found, top in (("pair", pairs, None), ("term", words_of, 10)):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(sorted(found)[:top])]
    return Counter(out)


@pytest.mark.parametrize("square,cut", [(256, 200_000), (1, 7)])
def test_divergence_is_that_of_brute_force(spark, monkeypatch, square, cut):
    monkeypatch.setattr(divergence, "SQUARE", square)
    monkeypatch.setattr(divergence, "SLICE", cut)
    monkeypatch.setattr(divergence, "BLOCK", 40)
    monkeypatch.setattr(divergence, "MERGED", 100)
    monkeypatch.setattr(divergence, "LEAST", 3)
    rows = some_docs() + [(900 + i, x, "xx", s) for i, (x, s) in enumerate([("rare", "u"), ("words", "v"), (None, "w")])]
    found = divergence.divergence(docs(spark, rows)).select("lang", "source", "part", "item", "value", "rank").collect()
    assert Counter(map(tuple, found)) == brute_divergence(rows)


def test_shares_leave_no_64_bits():
    counts, total = np.array([0, 3, 10**11, 7 * 10**15]), np.array([5, 10**10, 9 * 10**12, 9 * 10**15])
    wanted = [1 + 10**9 * (int(c) + 2) // int(m) for c, m in zip(counts, total, strict=True)]
    assert divergence.shares(counts, total).tolist() == wanted


def test_runs_merge_by_key():
    powers, blocks = rolling.Powers(), [divergence.Block(), divergence.Block()]
    for at, lang, source, text in ((0, "fr", "s", "C a a"), (0, "", "s", "a"), (1, "fr", "t", "a b"), (1, "fr", "s", "a c A"), (1, "fr", "s", "c")):
        blocks[at].add(pa.array([text]), [lang], [source], powers)
    runs = [block.run(i).select(["lang", "term", "source", "tf", "df"]) for i, block in enumerate(blocks)]
    assert [r["term"] for r in runs[1].to_pylist()] == ["a", "b", "c"]
    found = [tuple(r.values()) for r in divergence.merged_runs(runs).to_pylist()]
    assert sorted(found) == [("", "s", "a", 1, 1), ("fr", "s", "a", 4, 2), ("fr", "s", "c", 3, 3), ("fr", "t", "a", 1, 1), ("fr", "t", "b", 1, 1)]


def test_blocks_count_like_a_dictionary(monkeypatch):
    """Also texts that are cut into pieces, and numbers too large for one key."""
    monkeypatch.setattr(rolling, "CHUNK", 64)
    rows = [(lang or "", source or "", x or "") for _, x, lang, source in some_docs()]
    block, powers = divergence.Block(), rolling.Powers()
    for lang, source, x in rows:
        block.add(pa.array([x]), [lang], [source], powers)
    wanted = defaultdict(lambda: [0, 0])
    for lang, source, x in rows:
        for term, n in Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", x.translate(LOWER))).items():
            wanted[lang, term, source][0] += n
            wanted[lang, term, source][1] += 1
    block.docs, few = 1 << 60, block.docs
    lots = block.run(0)
    block.docs = few
    for run in (lots, block.run(0)):
        found = [(r["lang"], r["term"], s, n, d) for r in run.to_pylist() for s, n, d in zip(r["source"], r["tf"], r["df"], strict=True)]
        assert {x[:3]: list(x[3:]) for x in found} == wanted and len(found) == len(wanted)
        heads = [(r["lang"].encode(), r["term"].encode()) for r in run.to_pylist()]
        assert heads == sorted(set(heads))


def test_empty_tables_of_groups(spark):
    assert simhash.simhash_join(docs(spark, [])).count() == 0
    assert divergence.divergence(docs(spark, [])).count() == 0
    assert trie.prefix_trie(turns(spark, [])).count() == 0
