"""Language models that are larger than the part the tasks hold, plain ones of a few texts, rare and far-off letters."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from samples import EDGE
from haulage.llm import langid
from test_models import speak


@pytest.mark.parametrize("held", [1, 60, 300])
def test_no_run_is_lost_where_the_model_is_larger_than_its_part(frame, monkeypatch, held):
    rows = [(i, speak("aa", i), "aa", "s", 0) for i in range(150)]
    rows += [(200 + i, speak("bb", i), "bb", "s", 0) for i in range(20)]
    rows += [(400 + i, t, None, "s", 0) for i, t in enumerate(EDGE + ["qvx kato", "zz schgru äö"])] + [rows[0]]

    def found():
        out = langid.identify(frame(rows).repartition(3), F.lit(True)).collect()
        return sorted((r.doc.doc_id, r.lang_pred, r.rejected, r.entropy, r.score) for r in out)

    full = found()
    monkeypatch.setattr(langid, "MODEL_RUNS", held)
    part = found()
    assert len(part) == len(rows) and [r[:3] for r in part] == [r[:3] for r in full]
    assert [r[3:] for r in part] == [pytest.approx(r[3:], abs=1e-6) for r in full]


def plain_entropy(text, texts):
    """Cross-entropy by dictionaries: interpolated Kneser-Ney with one discount an order."""
    def chars(t):
        kept = "".join(c.lower() if c.isalpha() else " " for c in t)
        return ["^"] * 3 + list(" ".join(kept.split())) + ["^"]

    def clean(t):  # a space and the edge are one character
        return [" " if c in "^ " else c for c in chars(t)]

    of = {4: Counter(tuple(w[i - 3:i + 1]) for t in texts["own"] for w in [clean(t)] for i in range(3, len(w)))}
    every = {c for ts in texts.values() for t in ts for c in clean(t)[3:]}
    for k in (3, 2, 1):
        of[k] = Counter(run[1:] for run in of[k + 1])
    cut = {}
    for k, runs in of.items():
        a, b = (sum(n == x for n in runs.values()) for x in (1, 2))
        cut[k] = a / (a + 2 * b) if a and b else 0.5

    def p(run):
        k = len(run)
        if not k:
            return 1 / (len(every) + 1)
        same = [n for r, n in of[k].items() if r[:-1] == run[:-1]]
        if not same:
            return p(run[1:])
        return max(of[k].get(run, 0) - cut[k], 0) / sum(same) + cut[k] * len(same) / sum(same) * p(run[1:])

    w = clean(text)
    return -sum(math.log(p(tuple(w[i - 3:i + 1]))) for i in range(3, len(w))) / (len(w) - 3)


@pytest.mark.parametrize("held", [40, 1_000_000])
def test_entropies_are_those_of_a_plain_model(frame, monkeypatch, held):
    monkeypatch.setattr(langid, "MODEL_RUNS", held)
    texts = {"aa": [speak("aa", i, 9) for i in range(9)], "bb": [speak("bb", i, 7) for i in range(6)]}
    texts["aa"].append("Kato, MIRA \U00020000\U00020001!")
    rows = [(100 * k + i, t, lang, "s", 0) for k, (lang, ts) in enumerate(texts.items()) for i, t in enumerate(ts)]
    rows += [(900, "kato qqq mira", None, "s", 0), (901, "zwi ber", None, "s", 0)]
    # An astral letter is two characters, here as there.
    def spelt(t):
        units = t.encode("utf-16-le")
        return "".join(chr(0x4E00 + int.from_bytes(units[i:i + 2], "little") - 0xD800) if 0xD8 <= units[i + 1] < 0xE0
                       else units[i:i + 2].decode("utf-16-le") for i in range(0, len(units), 2))

    for r in langid.identify(frame(rows), F.lit(True)).collect():
        own = {lang: [spelt(t) for t in ts] for lang, ts in texts.items()}
        found = {lang: plain_entropy(spelt(dict((x[0], x[1]) for x in rows)[r.doc.doc_id]), {"own": own[lang]} | own) for lang in own}
        best = min(found, key=found.get)
        assert r.lang_pred == best and r.entropy == pytest.approx(found[best], abs=1e-4)


def letters(first, last, seed, n=200):
    pick = random.Random(seed)
    return "".join(chr(pick.randint(first, last)) for _ in range(n))


def test_rare_languages_and_all_scripts_are_told_apart(frame):
    scripts = {"han": (0x4E00, 0x4E40), "high": (0x8061, 0x80A1), "hangul": (0xAC00, 0xAC40), "latin": (0x61, 0x7A),
               "astral": (0x20000, 0x20040), "astral2": (0x20041, 0x20080)}
    rows = [(i, letters(*scripts[s], f"{s}{i}"), s, "s", 0) for k, s in enumerate(scripts) for i in range(100 * k, 100 * k + 30)]
    # Every row of these is put aside for calibration, or has no letter.
    aside = [r.id for r in frame([(i, "", "", "", 0) for i in range(5000, 9000)]).select(F.col("doc_id").alias("id")).where(
        F.pmod(F.xxhash64("id"), F.lit(langid.CALIBRATION)) == 0).collect()][:3]
    rows += [(i, speak("bb", i), "rare", "s", 0) for i in aside] + [(9999, "1 2 3", "none", "s", 0)]
    out = langid.identify(frame(rows + [(10000, letters(0xA000, 0xA040, 1), None, "s", 0)]), F.lit(True)).collect()
    assert len(aside) == 3 and {r.doc.lang for r in out if r.lang_pred != r.doc.lang} == {"none", None}
    assert all(r.lang_pred != "none" and 0 <= r.score <= 1 for r in out)


def test_rows_without_a_letter_teach_nothing(frame):
    out = langid.identify(frame([(1, "1 2", "aa", "s", 0), (2, "word", "aa", "s", 0), (3, None, "aa", "s", 0)]), F.col("doc_id") == 1)
    assert {(r.lang_pred, r.score) for r in out.collect()} == {("und", 0.0)}
