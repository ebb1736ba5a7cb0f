import random
import re
from statistics import median

import numpy as np
import pytest
from pickwise.llm import quality_rules
from pyspark.sql import functions as F

from .helpers import documents, odd_rows, prose

pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_force(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    where = {}
    for i in range(len(w) - 7):
        where.setdefault(tuple(w[i:i + 8]), []).append(i)
    rep = {i + j for at in where.values() if len(at) > 1 for i in at for j in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(rep)


def test_base_counts_equal_brute_force(spark):
    rows = odd_rows() + [(100 + i, "\n".join([prose(i, 30), "same line", prose(i + 1, 12) + " #tag <b>", "same line", prose(i, 30)]), "s") for i in range(30)]
    rows.append((500, "ab cd " * 400, "s"))
    got = {}
    for r in quality_rules.quality_rules(documents(spark, rows, clash=True)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text, _ in rows:
        if i is None:
            continue
        n, chars, symbols, dup, rep = by_force(text)
        for r in got[i]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep), i
            assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
            assert not (r.kept and r.base_failed)
    assert sum(map(len, got.values())) == len(rows)


def test_fertility_counts_tokens_of_whole_texts(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=quality_rules.tokenizer_file(quality_rules.PIECES, None))
    texts = [prose(1, 300), "été à la mer, l'eau " * 20, "слово и дело " * 30, "漢字かな " * 30]
    out = {r.doc_id: r for r in quality_rules.quality_rules(documents(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert out[i].n_tokens == len(sp.encode(t.strip())) and out[i].script == ("latin", "latin", "cyrillic", "other")[i]


def test_noise_is_rejected_and_prose_kept(spark):
    rng = random.Random(2)
    noise = " ".join("".join(chr(rng.randrange(0x2500, 0x27FF)) for _ in range(6)) + "ab" for _ in range(200))
    clean = ("the river bends around an old mill where people of that town have met for many years and talk about their work "
             "their children and how prices rise while wages stay what they were before last winter came with heavy snow")
    out = {r.doc_id: r.kept for r in quality_rules.quality_rules(documents(spark, [(1, noise, "s"), (2, clean, "s")])).collect()}
    assert out == {1: False, 2: True}


def test_kept_rows(spark):
    docs = documents(spark, odd_rows() + [(50, prose(9, 200), "s")], clash=True)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    want = [r.doc_id for r in quality_rules.quality_rules(docs).collect() if r.kept]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(i or -1 for i in want)
    assert quality_rules.quality_rules(documents(spark, [])).collect() == []


GERMAN = ("wasser morgen fenster garten strasse haus kinder schule abend winter sommer freund arbeit leben stadt berg fluss wald "
          "himmel brot tisch buch brief zeit woche monat jahr mutter vater bruder schwester hund katze vogel baum blume licht feuer "
          "erde meer insel land markt preis geld hand auge stimme lied wort frage antwort reise zug wagen tor mauer dach").split()


def band_rows():
    """Two languages of different fertility, one without name, one of few documents; every tenth
    German text has words of single letters among its own, which the limits allow."""
    rows = []
    for i in range(360):
        rng = random.Random(i)
        n = 60 + 7 * (i % 40)
        text = prose(i, n, vocabulary=300)
        if i % 3 == 1:
            text = " ".join(rng.choice(GERMAN) + (" " + rng.choice("bcdfghkmpqrtvwxz") + str(rng.randrange(90)) if i % 10 == 0 else "")
                            for _ in range(n))
        rows.append((i, text, ("en", "de", None)[i % 3]))
    return rows + [(400 + i, prose(i, 60) + " wasser" * 3, "few") for i in range(20)] + [(500, None, "en"), (501, "", "de"), (500, None, "en")]


def bands_by_force(rows):
    """kept from the measures of rows: medians of rounded values, language by language."""
    groups = {}
    for r in rows:
        if not r.base_failed and r.in_limits:
            groups.setdefault((r.script, r.lang), []).append(r)
    bands = {}
    for key, own in groups.items():
        if len(own) < quality_rules.LEAST_DOCS:
            continue
        for c in ("chars_per_token", "chars_per_byte_token"):
            mid = median(round(r[c] * 10000) for r in own) / 10000
            bands[key, c] = mid, quality_rules.SPREADS * median(round(abs(r[c] - mid) * r.n_tokens ** 0.5 * 100) for r in own) / 100
        x = sorted(round(r.token_entropy * 10000) for r in own if r.n_tokens >= 64)
        if len(x) >= quality_rules.LEAST_DOCS:
            mid = median(x) / 10000
            bands[key, "entropy"] = mid, 4 * (mid - float(np.quantile(x, 0.25)) / 10000)
    out = []
    for r in rows:
        ok = not r.base_failed and r.in_limits
        for c in ("chars_per_token", "chars_per_byte_token"):
            mid, half = bands.get(((r.script, r.lang), c), (0, float("inf")))
            ok = ok and abs(r[c] - mid) <= max(half / r.n_tokens ** 0.5, 0.05 * mid)
        mid, half = bands.get(((r.script, r.lang), "entropy"), (0, float("inf")))
        out.append((r.doc_id, ok and (r.n_tokens < 64 or r.token_entropy >= mid - max(half, 0.05 * mid))))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 5])
def test_bands_equal_brute_force(spark, parts):
    docs = (spark.createDataFrame(band_rows(), "doc_id long, text string, lang string")
            .withColumns({"measures": F.lit(1), "kept": F.lit("x"), "bands": F.lit(None).cast("int"), "two words": F.lit(2)}).repartition(parts))
    measured = docs.select("doc_id", "lang", "text").mapInArrow(
        quality_rules.measure_batches(None, quality_rules.LIMITS, ["doc_id", "lang"]), quality_rules._schema("doc_id long, lang string"))
    rows = measured.select("doc_id", "lang", "measures.*").collect()
    want = bands_by_force(rows)
    assert sorted((r.doc_id, r.kept) for r in quality_rules.quality_rules(docs).collect()) == want
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, ok in want if ok]
    assert quality_rules.keep_good(docs.filter("doc_id < 0")).collect() == []
    # The bands decide: stuffed German texts go, though the limits pass them; other German texts stay.
    got, passed = dict(want), {r.doc_id for r in rows if r.lang == "de" and r.in_limits and not r.base_failed}
    stuffed = {i for i in passed if i % 10 == 0}
    assert len(stuffed) >= 10 and not any(got[i] for i in stuffed)
    assert sum(got[i] for i in passed - stuffed) >= 0.95 * len(passed - stuffed) > 90
