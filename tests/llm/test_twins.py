"""Whole results against plain Python twins without hashes: rules and languages."""

import collections
import math
import random

from pyspark.sql import functions as F

from revlens.llm import langid, rules
from tests.llm import brute

DOCS = "doc_id long, text string"


def _likelihood(rows, trusted):
    """{doc_id: mean log ratio of its words and word pairs}."""
    def grams(text):
        w = brute.words(text)
        return w + list(zip(w, w[1:]))
    r = collections.Counter(g for _, t in rows for g in grams(t))
    t = collections.Counter(g for i, x in rows for g in grams(x) if i in trusted)
    nr, nt = sum(r.values()), sum(t.values())
    weight = {g: math.log((t[g] * nr / nt + rules.SMOOTHING) / (k + rules.SMOOTHING)) for g, k in r.items()}
    return {i: sum(weight[g] for g in grams(x)) / len(grams(x)) if grams(x) else 0.0 for i, x in rows}


def test_rules_equal_the_plain_scorer(spark):
    rng = random.Random(8)
    good, bad = ["un", "deux", "trois", "quatre"], ["spam", "##", "buy"]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad + good[:1]) for _ in range(rng.randrange(0, 120))))
            for i in range(120)] + [(200, None), (201, "un"), (202, " \n")]
    trusted = {i for i in range(120) if i % 6 == 1}
    got = {r.doc_id: r for r in rules.quality_rules(
        spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()}
    want = _likelihood(rows, trusted)
    for i, t in rows:
        n, _, _, _, repeat = brute.base_rules(t)
        failed = n < 50 or 100 * repeat > 50 * n
        assert abs(got[i].score - want[i]) < 1e-9 and got[i].base_failed == failed
        assert got[i].kept == (not failed and want[i] >= rules.LEAST_SCORE)


def _words(text):
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


def _grams(word, n):
    w = f" {word} "
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _languages(train, texts):
    """[(language, posterior)] of texts, learnt from (language, text) rows."""
    langs = sorted({x for x, _ in train})
    tables = []
    for n in range(langid.LONGEST + 1):
        k = {x: collections.Counter(g for lang, t in train if lang == x for w in _words(t)
                                    for g in (_grams(w, n) if n else [w])) for x in langs}
        least = langid.LEAST_GRAM if n else langid.LEAST_WORD
        keep = {g for x in langs for g in k[x] if sum(k[y][g] for y in langs) >= least}
        total = {x: sum(k[x][g] for g in keep) + 0.5 * max(1, len(keep)) for x in langs}
        tables.append({g: [math.log((k[x][g] + 0.5) / total[x]) for x in langs] for g in keep})
    out = []
    for t in texts:
        score = [0.0] * len(langs)
        for w in _words(t):
            for n in (0, *range(langid.LONGEST, 0, -1)):
                known = [tables[n][g] for g in (_grams(w, n) if n else [w]) if g in tables[n]]
                if known:
                    score = [s + sum(v[i] for v in known) / len(known) for i, s in enumerate(score)]
                    break
        best = max(score)
        out.append((langs[score.index(best)], 1 / sum(math.exp(s - best) for s in score)) if _words(t) else ("und", 0.0))
    return out


def test_languages_equal_the_plain_scorer(spark):
    rng = random.Random(9)
    sound = {"aa": "abcde", "bb": "bcdfé", "cc": "xyzaü"}
    vocabulary = {x: ["".join(rng.choice(s) for _ in range(rng.randrange(1, 7))) for _ in range(25)] for x, s in sound.items()}

    def text(x):
        own = [rng.choice(vocabulary[x]) if rng.random() < 0.8 else "".join(rng.choice(sound[x]) for _ in range(5))
               for _ in range(rng.randrange(1, 25))]
        return rng.choice([" ", ", ", "-"]).join(own).title() + rng.choice(["", "!", " 42"])
    rows = [(i, text(x), x) for i in range(150) for x in [rng.choice(list(sound))]]
    rows += [(300, None, "aa"), (301, "123 ..", None), (302, "Q", "bb"), (303, "", None), (304, text("aa") * 300, None)]
    d = spark.createDataFrame(rows, DOCS + ", lang string")
    model = langid.fit_language(d, F.col("doc_id") < 100)
    want = _languages([(x, t) for i, t, x in rows if i < 100], [t for _, t, _ in rows])
    got = {r.doc_id: r for r in langid.predict_language(d, model).collect()}
    for (i, _, _), (lang, p) in zip(rows, want):
        assert got[i].lang_pred == lang and abs(got[i].score - p) < 1e-6, i
