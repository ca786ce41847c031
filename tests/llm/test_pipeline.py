"""The pipeline's stages against plain Python: what each keeps of what its predecessor kept."""

import itertools
import random
import re
from collections import Counter

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, c0 long"
COPY = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def prose(seed, words, lang):
    r = random.Random(seed)
    letters = "abcdefghi" if lang == "aa" else "qrstuvwxyzé"
    return " ".join("".join(r.choice(letters) for _ in range(r.randrange(3, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    passages = [prose(900 + k, 20, "aa") for k in range(3)]
    rows = [(k, prose(k, 60 + k, "aa" if k % 2 else "qq"), "aa" if k % 2 else "qq", f"s{k % 3}") for k in range(40)]
    words = rows[4][1].split()
    rows += [(100, rows[4][1], "qq", "s0"), (101, "  " + rows[4][1].replace(" ", "\n", 2), "qq", "s1")]  # exact copies
    rows += [(110 + k, " ".join(words[:k * 9] + ["qqrr"] + words[k * 9 + 1:]), "qq", "s2") for k in range(1, 4)]  # near copies
    rows += [(120 + k, prose(300 + k, 30, "aa") + " " + p, "aa", "s0") for k, p in enumerate(passages)]  # benchmark passages
    rows += [(130, prose(330, 900, "aa") + " " + passages[0], "aa", "s1")]  # too little of one to go
    rows += [(140, None, "aa", "s0"), (141, "", "qq", "s0"), (142, "123 456 !", "aa", "s1"), (143, prose(343, 70, "aa"), None, None)]
    rows += [(None, prose(344, 80, "qq"), "qq", "s1"), (None, prose(345, 80, "aa"), "aa", None), (5, rows[5][1], "zz", "s9"), rows[7], rows[7]]
    rows += [(150, prose(350, 20000, "qq"), "qq", "s2")]
    path = str(tmp_path_factory.mktemp("corpus"))
    full = [(i, t, lang, source, None, "clash", 7) for i, t, lang, source in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, p) for k, p in enumerate([*passages, passages[0], None, ""])], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, [*passages]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def first_key(row):
    return (row[0] is None, row[0] or 0)


def linked(texts):
    sets = []
    for t in texts:
        w = WORD.findall(lower(t))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else []))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def hit_share(text, passages):
    words = ALNUM.findall(lower(text))
    hit = set()
    for p in passages:
        w = ALNUM.findall(lower(p))
        windows = {tuple(w[i:i + 13]) for i in range(len(w) - 12)}
        for i in range(len(words) - 12):
            if tuple(words[i:i + 13]) in windows:
                hit |= set(range(i, i + 13))
    return len(hit), len(words)


def test_stages_against_plain_python(spark, folder):
    path, passages = folder
    stages, docs = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns

    kept = stages["language"](spark, docs, path)
    assert kept.columns == columns
    given, found = rows_of(docs), rows_of(kept)
    lettered = Counter(r for r in given if r[1] and re.search("[a-zé]", r[1]))
    assert Counter(found) == lettered  # the two alphabets are told apart for certain

    kept = spark.createDataFrame(found, docs.schema).repartition(3)
    best = {}
    for r in found:
        key = COPY.sub("", r[1])
        order = (-len(r[1]), first_key(r), tuple((v is not None, v) for v in r))
        if key not in best or order < best[key][0]:
            best[key] = (order, r)
    expected = Counter(r for _, r in best.values())
    found = rows_of(stages["exact"](spark, kept, path))
    assert Counter(found) == expected

    found.sort(key=first_key)
    components = linked([r[1] for r in found])
    near = rows_of(stages["jaccard"](spark, spark.createDataFrame(found, docs.schema), path))
    assert len({first_key(r) for r in near if r[0] is not None}) == len([r for r in near if r[0] is not None])
    assert len(near) == len(set(components)) < len(found)
    with_id = [r for k, r in enumerate(found) if components[k] == k and r[0] is not None]
    assert Counter(r for r in near if r[0] is not None) == Counter(with_id)

    clean = rows_of(stages["benchmark"](spark, spark.createDataFrame(near, docs.schema), path))
    shares = [hit_share(r[1], passages) for r in near]
    assert Counter(clean) == Counter(r for r, (hit, n) in zip(near, shares) if not (hit and 20 * hit >= n))
    assert {120, 121, 122} <= {r[0] for r in near} and not {120, 121, 122} & {r[0] for r in clean} and 130 in {r[0] for r in clean}

    mixed = stages["mixture"](spark, spark.createDataFrame(clean, docs.schema), path).collect()
    known = {r[0]: r for r in clean}
    uses = Counter(r["doc_id"] for r in mixed)
    assert set(uses) <= set(known) and max(uses.values()) <= 5


def test_pipeline_runs_whole_and_on_nothing(spark, folder, tmp_path):
    path, _ = folder
    rows = corpus_pipeline.run(spark, path).collect()
    assert rows and not {120, 121, 122, 140, 141, 142} & {r["doc_id"] for r in rows}
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
