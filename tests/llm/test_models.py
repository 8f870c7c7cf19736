"""What SQL can't state, against plain versions: scores, verdicts, files and found spans."""

import collections
import glob
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hivelake.llm import _text, brown_lm, decision_list, pii_crf, token_output, toxicity
from hivelake.llm.queries import BYTE_PAIRS, tokenizer

SF = "/root/testdata/sf0.001"


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# 3

def classes_of(model):
    """The class of any word as the model has it."""

    def of(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        one = _text.words_of(raw, np.array([0, len(raw)]), lower=True)
        place = _text.Lookup(model.known).places(one.hash)[0]
        return int(model.label[place]) if place >= 0 else int(model.of_shape[brown_lm.shape_of(one)[0]])

    return of


def test_brown_scores_equal_the_formula_and_sum_to_one(spark):
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) + rng.choice(("", "", ".", "1")) for _ in range(120)]
    rows = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(120)])[0] for _ in range(rng.randint(0, 80)))) for i in range(150)]
    rows += [(200, None), (201, "quite unknown wörds 99"), (3, rows[3][1]), (3, rows[3][1]), (3, "other text of that id"), (None, "null a"), (None, "null a")]
    train, all_ = documents(spark, rows[:120]), documents(spark, rows)
    model = brown_lm.fit(train, exchange_words=30, exchange_classes=6, frequent_words=40, evidence=8)
    of, end = classes_of(model), len(model.within) - 1

    count, bigrams, seen = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for _, t in rows[:120]:
        before = end
        for w in [*words(t), None]:
            c = end if w is None else of(w)
            count[w] += 1
            seen[c].add(w)
            bigrams[before, c] += 1
            before = c
    n_classes = end + 1
    into = [sum(bigrams[a, c] for a in range(n_classes)) for c in range(n_classes)]
    share = [(x + 0.5) / (sum(into) + 0.5 * n_classes) for x in into]

    def move(a, c):
        return (bigrams[a, c] + brown_lm.LEAN * share[c]) / (sum(bigrams[a, x] for x in range(n_classes)) + brown_lm.LEAN)

    def emit(w, c):
        return (count[w] + 0.5) / (into[c] + 0.5 * (len(seen[c]) + 1))

    for a in range(n_classes):
        assert sum(move(a, c) * (sum(emit(w, c) for w in seen[c]) + 0.5 / (into[c] + 0.5 * (len(seen[c]) + 1))) for c in range(n_classes)) == pytest.approx(1)
    by = collections.defaultdict(list)
    for r in brown_lm.score(all_, model).collect():
        by[r.doc_id, r.n_tokens].append(r.score)
    assert sum(map(len, by.values())) == len(rows)
    for i, t in rows:
        want, before = 0.0, end
        for w in [*words(t), None]:
            c = end if w is None else of(w)
            want += math.log10(move(before, c)) + math.log10(emit(w, c))
            before = c
        assert any(s == pytest.approx(want, rel=1e-9) for s in by[i, len(words(t)) + 1]), (i, t)
    assert len(by[3, len(words(rows[3][1])) + 1]) == 3 and len(by[None, 3]) == 2


def test_lookup_equals_a_search():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 1000):
        known = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        asked = np.concatenate([known, known + np.uint64(1), rng.integers(0, 1 << 63, 50, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
        place = {int(k): i for i, k in enumerate(known)}
        assert _text.Lookup(known).places(asked).tolist() == [place.get(int(x), -1) for x in asked]


def test_brown_with_ties_at_the_top(spark):
    """All words as frequent as each other: more of them than places among the exchanged and the frequent ones."""
    rows = [(i, " ".join(f"w{(i + k) % 40}" for k in range(40))) for i in range(40)]
    model = brown_lm.fit(documents(spark, rows), exchange_words=10, exchange_classes=3, frequent_words=7)
    assert model.n_types == 41 and len(model.known) == 40 and model.label.max() < 3


# 4

def test_verdicts_equal_the_rules(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rng = random.Random(2)
    made = []
    for i in range(400):  # good prose, and poor texts of two kinds that the base rules let pass
        body = [rng.choice(("lorem", "ipsum", "dolor", "sit", "amet", "magna")) + str(rng.randint(0, 99)) for _ in range(90)]
        if i % 4 == 1:
            body = [w + "#" for w in body]
        if i % 4 == 2:
            body = [w.upper() for w in body]
        made.append((10_000 + i, " ".join(body)))
    docs = docs.select("doc_id", "text").unionByName(documents(spark, made))
    labels = labels.select("doc_id", "quality").unionByName(spark.createDataFrame([(i, int(i % 4 in (0, 3))) for i, _ in made], "doc_id long, quality int"))
    rules = decision_list.fit(docs, labels)
    assert rules
    counted = {r.id: r.asDict() for r in decision_list.statistics(docs).collect()}

    def covered(s):
        w, c, n = (max(1, s[k]) for k in ("n_words", "word_chars", "n_lines"))
        x = {
            "words": s["n_words"], "word_length": (s["word_chars"] - s["n_symbols"]) / w, "symbols_per_word": s["n_symbols"] / w, "repeated_lines": s["n_dup_lines"] / n, "repeated_words": s["n_repeat_words"] / w,
            "words_per_line": s["n_words"] / n, "upper_share": s["n_upper"] / c, "digit_share": s["n_digits"] / c, "stops_per_word": s["n_stops"] / w,
        }
        return any(all((x[k.measure] >= k.threshold) == k.at_least for k in rule) for rule in rules)

    got = decision_list.judge(docs, rules).collect()
    for r in got:
        assert r.kept == (not r.base_failed and not covered(counted[r.doc_id]))
    right = [r.kept == (r.doc_id % 4 in (0, 3)) for r in got if r.doc_id >= 10_000]
    assert sum(right) >= 0.95 * len(right)


# 5

def test_token_files_have_dictionaries_pages_and_row_groups(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randint(0, 50)}" for _ in range(300))) for i in range(4000)]
    out = str(tmp_path / "tokens")
    token_output.write_tokens(documents(spark, rows), out, tokenizer(BYTE_PAIRS), row_group_bytes=64 << 10, page_bytes=4 << 10)
    groups, low = 0, []
    for f in sorted(glob.glob(f"{out}/*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            columns = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
            assert {"RLE_DICTIONARY", "PLAIN_DICTIONARY"} & set(columns["ids"].encodings) and columns["ids"].has_dictionary_page
            assert columns["id"].has_offset_index and columns["id"].has_column_index and columns["ids"].has_offset_index
            assert columns["ids"].total_uncompressed_size < 4 * columns["ids"].num_values  # less than the plain numbers take
            low.append((columns["id"].statistics.min, columns["id"].statistics.max))
            groups += 1
    assert groups > 8
    low.sort()
    assert all(a[1] < b[0] for a, b in zip(low, low[1:], strict=False))  # ids ascend over the row groups
    some = token_output.read_tokens(spark, out).where("id = 30").select("id", "n_tokens")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,30)" in plan and "ids" not in plan.split("ReadSchema: ")[1].split("\n")[0] and some.count() == 1


# 6

def test_planted_data_is_found_in_documents(spark):
    """Secrets and numbers in forms of this test's own, put into texts of the table; and what was found where nothing was put."""
    rng = random.Random(77)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) BETWEEN 200 AND 4000").orderBy("doc_id").select("text").limit(150).collect()]
    model = pii_crf.train(pii_crf.example_rows())
    some = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    low, hexes, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "0123456789"
    caps = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    forms = [
        ("secret", lambda: ("Please use password: {} today", some(low + digits, 16))),
        ("secret", lambda: ("set api_key={} in the file", some(hexes, 32))),
        ("secret", lambda: ("my token is: {}", some(low + caps + digits, 36))),
        ("secret", lambda: ("aws AKIA key {} was left", "AKIA" + some(caps + "234567", 16))),
        ("secret", lambda: ("the secret: {} of ours", some(low, 20))),
        ("phone", lambda: ("call {} now", f"{some(digits[2:], 3)}-{some(digits, 3)}-{some(digits, 4)}")),
        ("ssn", lambda: ("SSN {} on file", f"{some(digits[1:9], 3)}-{some(digits, 2)}-{some(digits, 4)}")),
        ("iban", lambda: ("IBAN {} for payment", "DE" + some(digits, 20))),
        ("email", lambda: ("write to {} soon", f"{some(low, 6)}.{some(low, 5)}@{some(low, 7)}.org")),
        ("ip", lambda: ("from {} yesterday", ".".join(str(rng.randint(1, 255)) for _ in range(4)))),
    ]
    planted, wanted = [], []
    for i, t in enumerate(texts):
        kind, form = forms[i % len(forms)]
        sentence, value = form()
        cut = t.find(" ", rng.randrange(len(t) // 2)) + 1
        head = t[:cut] + sentence.split("{}")[0]
        planted.append(head + value + sentence.split("{}")[1] + " " + t[cut:])
        wanted.append((len(head), len(head) + len(value), kind))
    before = pii_crf.all_spans(texts, model)
    after = pii_crf.all_spans(planted, model)
    caught = [any(a < w[1] and w[0] < b and k == w[2] for a, b, k in every) for w, (_, every) in zip(wanted, after, strict=True)]
    whole = [w in every for w, (_, every) in zip(wanted, after, strict=True)]
    assert sum(caught) >= 0.9 * len(caught), [p[w[0] - 20 : w[1] + 5] for p, w, c in zip(planted, wanted, caught, strict=True) if not c]
    assert sum(whole) >= 0.85 * len(whole)
    new = sum(len(every) for _, every in after) - sum(len(every) for _, every in before)
    assert sum(caught) / max(1, new) >= 0.9  # what is found more than before is what was put there
    harmless = [t for t, (_, every) in zip(texts, before, strict=True) if not every]
    assert len(harmless) >= 0.5 * len(texts)


def test_many_spans_take_linear_time():
    model = pii_crf.train(pii_crf.example_rows())
    text = " ".join(f"a{i}@b.cd password: 9f{i * 7919:014x}a" for i in range(4000))
    (base, every), = pii_crf.all_spans([text], model)
    assert len(base) >= 4000 and len(every) >= 7900


# 8

def plain_grams(text):
    """N-grams of the marked words, and the words; a letter is a-z, 0-9 or lies beyond ASCII's signs."""
    marked, word = set(), []
    cleaned = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in [*cleaned, "\0"]:
        p = ord(c)
        letter = 97 <= p <= 122 or 48 <= p <= 57 or (p >= 0xC0 and p not in (0xD7, 0xF7) and not 0x2000 <= p < 0x3040)
        if letter:
            word.append(p)
            continue
        if word:
            whole = (0, *word, 0)
            marked.add((0, whole))
            for size in toxicity.SIZES:
                marked |= {(size, whole[i : i + size]) for i in range(len(whole) - size + 1)}
        word = []
    return marked


def plain_hash(gram):
    size, points = gram
    value = sum((p + 1) * pow(int(_text._BASE), i, 1 << 64) for i, p in enumerate(points)) % (1 << 64)
    return (value * (2 * size * 0x632BE5AB + 0x9E3779B97F4A7C15) % (1 << 64)) >> (64 - toxicity.BITS)


def test_ngrams_equal_a_plain_version():
    texts = ["", "Hello, world-wide Hello", "été 日本語 x×y", "a", "ab", " zounds!zounds ", "ß—ü—q", "the quick brown fox"]
    for _, _, row, h in toxicity.features(pa.array(texts)):
        for i, t in enumerate(texts):
            assert set(h[row == i].tolist()) == {plain_hash(g) for g in plain_grams(t)}


def test_toxicity_scores_equal_a_plain_version(spark):
    rng = random.Random(14)
    vocabulary = ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(2, 5))) for _ in range(30)]
    rows, labels = [], {}
    for i in range(260):
        bad = rng.random() < 0.3
        text = [rng.choice(vocabulary) for _ in range(12)] + (["zounds"] if bad and rng.random() < 0.9 else [])
        rows.append((i, " ".join(text)))
        labels[i] = int(bad)
    docs = documents(spark, rows)
    table = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_all(docs, table).collect()}

    train = [i for i in labels if not got[i].held_out]
    sets = {i: {plain_hash(g) for g in plain_grams(t)} for i, t in rows}
    held = collections.Counter((h, labels[i]) for i in train for h in sets[i])
    kept = sorted({h for h, _ in held if held[h, 0] + held[h, 1] >= toxicity.LEAST_TEXTS})
    n = collections.Counter(labels[i] for i in train)
    ratio = np.array([math.log((held[h, 1] + 1) / (n[1] + 2)) - math.log((held[h, 0] + 1) / (n[0] + 2)) for h in kept])
    x = np.array([[h in sets[i] for h in kept] for i in train]) * ratio
    y = np.array([labels[i] for i in train])
    w, b = np.zeros(len(kept)), 0.0
    for _ in range(60):  # Newton's method on the penalised likelihood
        p = 1 / (1 + np.exp(-(x @ w + b)))
        slope = np.append(x.T @ (p - y) + toxicity.PENALTY * w, (p - y).sum())
        full = np.column_stack([x, np.ones(len(y))])
        curve = full.T @ (full * (p * (1 - p))[:, None]) + np.diag(np.append(np.full(len(kept), toxicity.PENALTY), 1e-9))
        step = np.linalg.solve(curve, slope)
        w, b = w - step[:-1], b - step[-1]
    for i, _ in rows:
        z = b + sum(wi * r for wi, r, h in zip(w, ratio, kept, strict=True) if h in sets[i])
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-z)), abs=5e-3)
    assert docs.where(F.lit(True)).count() == len(got)
