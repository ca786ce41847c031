"""Operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearsay.llm import chat, decontaminate, exact_dedup, jaccard_join, language, mixing, repeated_bytes, repeated_words, secrets, toxicity

SPACE = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row_key string, kept string"


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}é" if r.random() < 0.1 else f"w{r.randrange(vocabulary)}" for _ in range(words))


@pytest.fixture(scope="module")
def texts():
    base, passage = prose(1, 160, 10**6), prose(2, 90, 10**6)
    words = base.split()
    near = [" ".join(words[:i] + [f"edit{i}"] + words[i + 1 :]) for i in (3, 40, 77, 120)]
    found = [
        base, base, "  " + base.replace(" ", "\t", 3), *near, passage + " " + prose(3, 50, 10**6), prose(4, 30, 10**6) + "\n" + passage,
        None, "", "   \n", "one two", "one two", "One\x0bTwo", passage[:380], "a" * 1500, "ab " * 700, prose(5, 6000, 300),
        passage + passage, base.upper(), "é" * 900, None, "x",
    ]
    return list(enumerate(found))


def table(spark, rows):
    full = [(i, t, "en", f"s{i % 3}" if i is not None and i % 4 else None, None, 7, "clash", "clash") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def by_id(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r["doc_id"]].append(r)
    return found


def runs(flags):
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.array(flags, dtype=np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


@pytest.mark.parametrize("bin_windows,shard_bytes", [(1 << 20, 1 << 20), (2000, 30000)])
def test_repeated_words(spark, texts, bin_windows, shard_bytes):
    rows = texts + [(None, texts[0][1]), texts[0]]
    words = {k: re.findall(SPACE, t or "") for k, (_, t) in enumerate(rows)}
    order = [math.inf if i is None else i for i, _ in rows]
    first = {}
    for k, w in words.items():
        for p in range(len(w) - 12):
            key = tuple(w[p : p + 13])
            first[key] = min(first.get(key, math.inf), order[k])
    expected = defaultdict(list)
    for k, w in words.items():
        flags = [False] * len(w)
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < order[k]:
                flags[p : p + 13] = [True] * 13
        expected[rows[k][0]].append((len(w), runs(flags), " ".join(x for x, f in zip(w, flags) if not f)))
    found = by_id(repeated_words.repeated_words(table(spark, rows), bin_windows=bin_windows, shard_bytes=shard_bytes))
    got = {i: sorted((r["n_words"], [(s["first"], s["end"]) for s in r["removed"]], r["kept"]) for r in rs) for i, rs in found.items()}
    assert got == {i: sorted(v) for i, v in expected.items()}


@pytest.mark.parametrize("length", [400])
def test_repeated_bytes(spark, texts, length):
    rows = texts + [(None, texts[0][1]), texts[0]]
    rng = random.Random(8)
    for period in (1, 2, 3, 7, 19, 40, 64, 65, 90):  # low periods, in a text of their own and inside another
        unit = "".join(rng.choice("abcdé ") for _ in range(period))
        rows += [(200 + period, unit * (900 // period)), (300 + period, prose(period, 60, 10**6) + unit * (500 // period) + prose(99, 9, 10**6))]
    for size in (399, 400, 401, 460, 530, 700):  # copies too short for whole runs of blocks
        copy = prose(600 + size, 200, 10**6)[:size]
        rows += [(400 + size, copy), (1200 + size, copy), (2000 + size, prose(size, 40, 10**6) + copy + prose(size + 1, 40, 10**6))]
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    expected = defaultdict(list)
    for (i, _), b in zip(rows, data):
        flags = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                flags[p : p + length] = True
        expected[i].append((len(b), runs(flags), bytes(np.frombuffer(b, np.uint8)[~flags])))
    found = by_id(repeated_bytes.repeated_bytes(table(spark, rows), length=length, bin_strings=4000, shard_bytes=30000))
    got = {i: sorted((r["n_bytes"], [(s["first"], s["end"]) for s in r["removed"]], bytes(r["kept"])) for r in rs) for i, rs in found.items()}
    assert got == {i: sorted(v) for i, v in expected.items()}


def shingles(text):
    w = re.findall(SPACE, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])


@pytest.mark.parametrize("bin_shingles", [1 << 21, 2500])
def test_jaccard_join(spark, texts, bin_shingles):
    rng = random.Random(9)
    family = [prose(1, 160, 10**6).split() for _ in range(40)]
    for w in family:
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
    rows = texts + [(100 + i, " ".join(w)) for i, w in enumerate(family)]
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = jaccard_join.jaccard_join(table(spark, rows), bin_shingles=bin_shingles).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_blocks_and_rounds_agree(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for f in range(6):
        base = prose(50 + f, 120, 10**6).split()
        for k in range(20):
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = f"q{rng.randrange(10**6)}"
            rows.append((f * 100 + k, " ".join(w)))
    plain = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_join(table(spark, rows)).collect()}
    monkeypatch.setattr(jaccard_join, "SETTLED", 2.0)  # one round only: the rest is left to the blocks
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 3)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_join(table(spark, rows)).collect()} == plain


def test_exact_dedup(spark, texts):
    rows = texts + [(None, "x"), (3, texts[3][1])]
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    expected = Counter()
    for body, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        for _, _, i in members:
            expected[(i, keep, len(members), i == keep, hashlib.sha256(body.encode()).hexdigest())] += 1
    for options in ({}, {"capacity": 2}, {"hot_bytes": 200}):
        assert Counter(tuple(r) for r in exact_dedup.exact_dedup(table(spark, rows), **options).collect()) == expected


def test_texts_under_one_hash_are_told_apart_by_their_bytes(spark, texts):
    same = lambda text: F.when(F.length(text) > 1000, F.lit(-5)).otherwise(F.lit(7)).cast("long")
    rows = texts + [(100 + i, "copied text") for i in range(40)] + [(None, "x")]
    plain = Counter(tuple(r) for r in exact_dedup.exact_dedup(table(spark, rows)).collect())
    for options in ({}, {"hot_bytes": 100}):
        assert Counter(tuple(r) for r in exact_dedup.exact_dedup(table(spark, rows), key=same, **options).collect()) == plain
    index = exact_dedup.exact_index(table(spark, rows), key=same).collect()
    assert {r["hash"] for r in index} == {-5, 7} and all(r["body"] is not None for r in index)
    for h in (-5, 7):
        chain = [r for r in index if r["hash"] == h]
        assert sorted(r["link"] for r in chain) == list(range(1, len(chain) + 1)) and len({r["bucket"] for r in chain}) == 1


def test_directory_splits_only_overfull_buckets(spark):
    plain = spark.range(5000).select(F.xxhash64("id").alias("hash"))
    crowded = plain.union(spark.range(1000).select((F.col("id") + F.lit(3 << 40)).alias("hash")))  # one long common prefix
    for hashes in (plain, crowded.filter("hash >= 0")):
        depth, found = exact_dedup.directory(hashes, 100)
        entries = {r["slot"]: r for r in found.collect()}
        values = [r["hash"] % (1 << 64) for r in hashes.collect()]
        held = Counter(entries[v >> (64 - depth)]["bucket"] for v in values)
        assert sum(held.values()) == len(values) and max(held.values()) <= 100
        assert max(r["depth"] for r in entries.values()) == depth
        for r in entries.values():  # a bucket's parent would be overfull
            shift = 64 - depth + depth - r["depth"] + 1
            if r["depth"]:
                parent = (r["bucket"] << (64 - depth)) >> shift
                assert sum(v >> shift == parent for v in values) > 100
    depth, found = exact_dedup.directory(plain, 10**6)
    assert depth == 0 and [tuple(r) for r in found.collect()] == [(0, 0, 0)]


def test_decontaminate(spark, texts):
    items = [("b", " ".join(texts[7][1].split()[5:40])), ("a", "one TWO"), ("c", None), ("d", ""), ("a", "one two"), (None, "x"), ("e", prose(77, 20))]

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    windows = defaultdict(set)
    for name, t in items:
        w = words(t)
        size = min(13, len(w))
        for p in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[p : p + size])].add(name or "")
    rows = texts + [texts[0]]
    expected = Counter()
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for win, owners in windows.items():
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    names |= owners
        expected[(i, len(w), len(hit), len(names), tuple(sorted(names)), len(hit) > 0 and 20 * len(hit) >= len(w))] += 1
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block_bytes in (1 << 20, 250):
        found = decontaminate.decontaminate(table(spark, rows), bench, block_bytes=block_bytes).drop("row_key").collect()
        assert Counter((r[0], r[1], r[2], r[3], tuple(r[4]), r[5]) for r in found) == expected


def entropy_spans(text, base):
    """What the entropy kinds should find, by counting every window anew."""
    out = []
    for order, (kind, pattern, _, least) in enumerate(secrets.ENTROPY_KINDS, 3):
        for m in re.finditer(pattern, text):
            if re.search(secrets.ALLOWED, m.group(0)) or any(a <= m.start() and m.end() <= b for a, _, _, b in base):
                continue
            w, high = m.group(0), []
            for p in range(len(w) - 19):
                c = Counter(w[p : p + 20])
                if -sum(n / 20 * math.log2(n / 20) for n in c.values()) >= least - 1e-9:
                    high.append(p)
            if high:
                out.append((m.start() + high[0], order, kind, m.start() + high[-1] + 20))
    return out


def test_secret_scan(spark):
    key = "aB3dE5gH7jK9mN1pQ2rS4tU6"
    rows = list(enumerate([
        None, "", "no secrets here", "API_KEY: 'abcdef' é password=12345 token = \"123456\"", "😀 secret=token: abcdefgh passwd:aaaaaa",
        "AKIA" + "A" * 16 + " AKIAAKIA", "x" + "0a" * 12 + " " + "ab" * 11, key, f"use {key} and /usr/local/share/some/long_path_name/x1",
        "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1B", "0123456789ABCDEF0123456789", "123e4567-e89b-12d3-a456-426614174000", "z" * 5000 + key * 3, key + "EXAMPLE",
    ]))
    assign = re.compile("(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w).replace("_", "_?") for w in ("password", "passwd", "secret", "token", "api_key")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = {r["doc_id"]: [tuple(x) for x in r["findings"]] for r in secrets.secret_scan(table(spark, rows)).collect()}
    for i, t in rows:
        t = t or ""
        base = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m.group(2)) >= 6]
        base += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group(0)) >= 20]
        base += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group(0)) >= 24]
        assert found[i] == sorted(base + entropy_spans(t, base)), t
    assert found[7] and not found[11] and not found[13]


def test_secret_scan_of_two_classes(spark):
    keys = ["q7x9f2kz8m4w1b6n3v5t0j", "Q7X9F2KZ8M4W1B6N3V5T0J", "qXfZkMwBnVtJ+pRsGhLyCd", "k3+9zt7w=q1m5x8v2b6n4/"]
    ordinary = ["zzzzzzzzzzzzzzzzzzzzzzzz1", "internationalization", "SOME_LONG_CONSTANT_NAME_2", "usr/local/lib2/python3/site", "some-long-page-name-2024"]
    rows = list(enumerate([f"é use {k}, then" for k in keys] + ordinary + ["0a1b2c3d4e5f6a7b8c9d0e", "aB3dE5gH7jK9mN1pQ2rS4tU6"]))
    found = {r["doc_id"]: [tuple(x) for x in r["findings"]] for r in secrets.secret_scan(table(spark, rows)).collect()}
    for i, key in enumerate(keys):
        assert found[i] == [(6, 5, "entropy_key", 6 + len(key))], key
    assert not any(found[len(keys) + i] for i in range(len(ordinary)))
    assert [[f[2] for f in found[i]] for i in (9, 10)] == [["entropy_hex"], ["entropy_base64"]]


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), "en", rng.choice(["a"] * 20 + ["b"] * 4 + ["c", None]), None, 7, "", "") for i in range(600)]
    rows += [rows[0], (None, None, None, "empty", None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    tokens = Counter()
    for r in rows:
        tokens[r[3]] += len((r[1] or "").split())
    tokens = {k: v for k, v in tokens.items() if v}
    total = sum(tokens.values())
    for target in (mixing.Target(repetition=3.0), mixing.Target(entropy=0.8), mixing.Target(entropy=1.0)):
        found = mixing.mix(docs, target, block_tokens=200).collect()
        used, weight = Counter(), {}
        for r in found:
            used[r["source"]] += r["n_tokens"]
            weight[r["source"]] = r["weight"]
        assert set(used) == set(tokens) and abs(sum(weight.values()) - 1) < 1e-9
        for s, t in used.items():
            assert weight[s] * total - 41 <= t <= weight[s] * total + 1
        if target.repetition:
            assert max(weight[s] * total / tokens[s] for s in tokens) == pytest.approx(3.0, abs=1e-4)
        else:
            entropy = -sum(w * math.log(w) for w in weight.values())
            assert entropy == pytest.approx(target.entropy * math.log(len(tokens)), abs=1e-5)
        uses = Counter((r["doc_id"], r["epoch"]) for r in found)
        assert max(n for (i, _), n in uses.items() if i != rows[0][0]) == 1
        again = mixing.mix(docs.repartition(7), target, block_tokens=200).collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    assert mixing.mix(docs.limit(0), mixing.Target(repetition=2.0)).count() == 0
    with pytest.raises(ValueError):
        mixing.Target()


def brute_cost(roles):
    """Least cost over every sequence of choices."""
    best = math.inf
    states = {chat.START: 0.0}
    for role in roles:
        new = {}
        for state, cost in states.items():
            for before, after, _, price, _ in chat.OPTIONS:
                if before == state:
                    total = cost + price + (0 if role == after else chat.RELABEL)
                    new[after] = min(new.get(after, math.inf), total)
        states = new
    for state, cost in states.items():
        best = min(best, cost + chat.END[state])
    return best


def legal(roles):
    if roles and roles[0] == "system":
        roles = roles[1:]
    return bool(roles) and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(roles)) and roles[-1] == "assistant"


@pytest.mark.parametrize("block", [256, 2])
def test_chat_repair(spark, block):
    rng = random.Random(11)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", None, " User ", "user", "assistant"])
            rows.append((conv, turn, role, rng.choice(["hello", "", None, "text"]), "extra"))
    rows += [(None, 1, "assistant", "a", ""), (70, None, "user", "first", ""), (70, 3, "assistant", "x", ""), (70, 3, "assistant", "x", "")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    found = chat.repair_chats(given, block_turns=block).collect()
    codes = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        code = chat.ROLES.get((role or "").strip().lower(), -1)
        codes[conv].append((-1 if turn is None else turn, code, text or ""))
    chats = defaultdict(list)
    for r in found:
        chats[r["conv_id"]].append(r)
    assert set(chats) == set(codes)
    for conv, pieces in chats.items():
        pieces.sort(key=lambda r: (-1 if r["turn"] is None else r["turn"], r["part"], r["piece"]))
        roles = [r["role"] for r in pieces if r["opens"]]
        assert legal(roles), (conv, roles)
        assert pieces[0]["cost"] == brute_cost([c for _, c, _ in sorted(codes[conv])])
        text = "".join(r["rendered"] for r in pieces)
        assert text.count("<|end|>") == len(roles) - 1 and text.startswith(f"<|{roles[0]}|>\n")
        assert sum(r["action"] != "insert" for r in pieces) == len(codes[conv])
    assert chat.repair_chats(given.limit(0)).count() == 0


@pytest.mark.parametrize("turn", [None, 3])
def test_chat_blocks_are_cut_by_rows(spark, monkeypatch, turn):
    """Rows without a conversation and of one turn number, many of them equal, fall into blocks of few rows."""
    blocks, write = [], chat.Rounds.write

    def watch(work, df, name):
        written = write(work, df, name)
        if name == "blocks":
            blocks.extend(r[0] for r in written.select(F.size("codes")).collect())
        return written

    monkeypatch.setattr(chat.Rounds, "write", watch)
    rng = random.Random(13)
    rows = [(None, turn, rng.choice(["user", "assistant", "tool"]), rng.choice(["a", "b", None])) for _ in range(600)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted(chat.repair_chats(given, block_turns=16).collect(), key=lambda r: (r["part"], r["piece"]))
    assert max(blocks) <= 16 and sum(blocks) == len(rows)
    order = sorted((chat.ROLES.get(r, -1), t or "") for _, _, r, t in rows)
    assert found[0]["cost"] == brute_cost([c for c, _ in order])
    assert legal([r["role"] for r in found if r["opens"]])
    own = [r for r in found if r["action"] != "insert"]
    assert [r["part"] for r in own] == list(range(len(rows)))
    assert [r["rendered"].rpartition("\n")[2] for r in own] == [t for _, t in order]


def test_language(spark):
    alphabets = {"aa": "abcde", "bb": "defgh", "cc": "αβγδε"}
    rng = random.Random(2)
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(alphabets))
        rows.append((i, " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(12)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.filter("doc_id % 2 = 0"), bits=12)
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "123 ... !"), (903, "αβγ" * 20000)], "doc_id long, text string")
    found = {r[0]: (r[1], r[2]) for r in language.predict(docs.select("doc_id", "text").unionByName(odd), model, ["doc_id"]).collect()}
    truth = {r[0]: r[2] for r in rows if r[0] % 2}
    assert sum(found[i][0] == lang for i, lang in truth.items()) >= 0.99 * len(truth)
    assert all(found[i] == ("und", 0.0) for i in (900, 901, 902)) and found[903][0] == "cc"
    assert all(0 <= s <= 1 for _, s in found.values())
    empty = language.fit(docs.limit(0))
    assert {r[1] for r in language.predict(docs, empty, ["doc_id"]).collect()} == {"und"}


def test_language_counts_match_a_plain_model(spark):
    rows = [("ab ab", "x"), ("ba", "y"), ("Ab", "x"), (None, "y"), ("zz", None)]
    names, prior, matrix = language.fit(spark.createDataFrame(rows, "text string, lang string"), bits=10, smoothing=1.0)
    assert names == ["x", "y"] and np.allclose(np.exp(prior), [0.5, 0.5])
    assert np.allclose(np.exp(matrix.astype(float)).sum(axis=0), 1, atol=1e-4)


def plain_grams(text, bits):
    """Buckets of a text's n-grams, as the model hashes them: letters in lower case, all else as one sign."""
    signs = [(ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if c.isalpha() else 0 for c in text]
    found = []
    for order in language.ORDERS:
        for i in range(len(signs) - order + 1):
            gram = signs[i : i + order]
            if (order == 1 and not gram[0]) or any(a == b == 0 for a, b in zip(gram, gram[1:])):
                continue
            key = language.packed.window_keys(np.array(gram, dtype=np.uint64) + np.uint64(order), order)[0]
            found.append(int(key) >> (64 - bits))
    return found


def test_language_equals_a_plain_naive_bayes(spark):
    rng = random.Random(8)
    letters = {"x": "abcde ", "y": "cdefgÉ 1", "z": "aβγç  .", "same": "aβγç  ."}
    learned = [("".join(rng.choice(letters[k]) for _ in range(rng.randrange(0, 60))), k) for k in letters for _ in range(12)] + [(None, "x"), ("abc", None)]
    asked = [t for t, _ in learned] + ["", "...", "1 2 3", "a", "É", "new wordsé", "ab" * 30000, "a", "a"]
    bits = 9
    counts, seen = {k: Counter() for k in letters}, Counter(k for _, k in learned if k)
    for text, k in learned:
        if k:
            counts[k].update(plain_grams(text or "", bits))
    norm = {k: math.log(sum(counts[k].values()) + 0.1 * (1 << bits)) for k in letters}
    expected = []
    for i, text in enumerate(asked):
        if not any(c.isalpha() for c in text or ""):
            expected.append((i, "und", 0.0))
            continue
        grams = Counter(plain_grams(text, bits))
        scores = {k: math.log(seen[k] / sum(seen.values())) + sum(n * (math.log(counts[k][g] + 0.1) - norm[k]) for g, n in grams.items()) for k in letters}
        top = max(sorted(scores), key=scores.get)
        expected.append((i, top, 1 / sum(math.exp(max(s - scores[top], -700)) for s in scores.values())))
    model = language.fit(spark.createDataFrame(learned, "text string, lang string"), bits=bits)
    docs = spark.createDataFrame([(i, t, "clash", 0.5) for i, t in enumerate(asked)], "doc_id long, text string, lang_pred string, c0 double")
    for keep in (["doc_id"], ["doc_id", "text", "c0"]):
        found = sorted(language.predict(docs.repartition(2), model, keep).collect(), key=lambda r: r[0])
        assert [(r[0], r[-2]) for r in found] == [e[:2] for e in expected]
        assert np.allclose([r[-1] for r in found], [e[2] for e in expected], atol=1e-3)
        assert keep[1:] == [] or [(r["text"], r["c0"]) for r in found] == [(t, 0.5) for t in asked]
    assert language.predict(docs.limit(0), model, ["doc_id", "text"]).collect() == []


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    bad = ["scum", "moronic", "vileness"]
    rows = []
    for i in range(900):
        toxic = rng.random() < 0.2
        words = [f"w{'abcdefghij'[rng.randrange(10)]}{'klmnop'[rng.randrange(6)]}x" for _ in range(30)]
        if toxic:
            words.insert(rng.randrange(30), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic) if rng.random() > 0.02 else int(not toxic), i % 3 == 1, toxic))
    rows += [(1000, None, None, False, False), (1001, "", None, True, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, held_out boolean, truth boolean")
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, docs.filter("not held_out and label is not null")).collect()}
    held = [(found[i], truth) for i, _, _, h, truth in rows if h]
    assert sum((s >= 0.7) == t for s, t in held) >= 0.97 * len(held)
    assert found[1000] == found[1001] < 0.5
    none = toxicity.toxicity(docs, docs.limit(0)).collect()
    assert len(none) == len(rows) and all(r["score"] < 1e-6 for r in none)


def test_toxicity_learns_from_rare_patterns(spark):
    """``zorkel`` fires only in sets of features that occur once, behind more than 4,096 that occur twice."""
    weak = [f"{a}{b}{c}" for a, b, c in itertools.islice(itertools.product("bdg", "aeo", "kmn"), 14)]
    sets = [[w for j, w in enumerate(weak) if k >> j & 1] for k in range(1, 1 << 13)]
    rows = [(" ".join(s), None) for s in sets for _ in range(2)]
    rows += [(" ".join([*weak[13:], *s, "zorkel"]), None) for s in sets[::40]]
    rows += [(f"zorkel {w}", 1) for w in weak] + [(w, i % 5 < 3) for i, w in enumerate(weak * 20)] + [("plain", 0)] * 200
    rows = [(i, t, None if y is None else int(y), False) for i, (t, y) in enumerate(rows)]
    rows += [(-1, "zorkel", None, True), (-2, "plain", None, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, held_out boolean")
    scored = toxicity.toxicity(docs, docs.filter("label is not null"))
    found = {r["doc_id"]: r["score"] for r in scored.filter("doc_id < 0").collect()}
    assert found[-1] > found[-2] + 0.3


def test_toxicity_totals_match_a_plain_sum(spark):
    rng = random.Random(8)
    rows = [(sorted(rng.sample(range(6), rng.randrange(0, 5))), rng.randrange(1, 5), rng.random()) for _ in range(300)]
    table_ = spark.createDataFrame(rows, "found array<int>, n long, label double").repartition(5)
    x = np.array([[float(j in f) for j in range(6)] for f, _, _ in rows])
    n, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    found = toxicity.totals(table_, 6, 42, lambda x, n, y: np.concatenate([(n * y) @ x, ((x * n[:, None]).T @ x).ravel()]))
    assert np.allclose(found, np.concatenate([(n * y) @ x, ((x * n[:, None]).T @ x).ravel()]))
    w, bias = toxicity.logistic(table_, 6)
    p = 1 / (1 + np.exp(-(x @ w + bias)))
    assert np.allclose(x.T @ (n * (p - y)) + w, 0, atol=1e-4) and abs((n * (p - y)).sum()) < 1e-3


@pytest.mark.parametrize("run", [
    lambda d: repeated_words.repeated_words(d), lambda d: repeated_bytes.repeated_bytes(d), lambda d: jaccard_join.jaccard_join(d),
    lambda d: exact_dedup.exact_dedup(d), lambda d: secrets.secret_scan(d), lambda d: decontaminate.decontaminate(d, d.select(F.col("doc_id").alias("item_id"), "text")),
])
def test_empty_tables(spark, run):
    assert run(table(spark, [(1, "x")]).filter("doc_id = 2")).count() == 0
