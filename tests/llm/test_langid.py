import random
import subprocess
import sys
import zlib

from conftest import SF

from foroscope.llm import langid
from foroscope.llm.langid import SIZE, bundles, languages, letters

from .conftest import ODD


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    got = languages(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got) and out
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) / len(out) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_only_text_and_lang_of_the_taught_rows_count(spark, frame):
    rows = [(i, ("the cat and the dog " if i % 2 else "le chat et le chien ") * 5, "en" if i % 2 else "fr", f"s{i}")
            for i in range(60)]
    first = {r.doc_id: (r.lang_pred, r.score) for r in languages(frame(rows)).collect()}
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, "z") for i, t, lang, _ in rows]
    assert {r.doc_id: (r.lang_pred, r.score) for r in languages(frame(wrong)).collect()} == first
    assert all(first[i][0] == lang for i, _, lang, _ in rows)


def test_odd_rows(frame):
    rows = [*[(i, t, "en" if i else None) for i, t in ODD], (40, "123 !?", "en"), (41, "Ünïcödé ΑΒΓ", None)]
    got = languages(frame(rows)).collect()
    assert len(got) == len(rows)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 5, 40))
    assert all(r.held_out for r in got if r.doc_id is None)
    assert {r.lang_pred for r in languages(frame([(1, "text", None)])).collect()} == {"und"}
    assert languages(frame([])).count() == 0


def test_bundles_add_up():
    texts = [letters(t) for t in ("some words here", "other words", "", "x")]
    each = bundles(list(enumerate(texts)), 4)
    assert (bundles([(0, t) for t in texts], 1)[0] == each.sum(axis=0)).all()
    assert each.shape == (4, SIZE) and not each[2].any() and abs(each[3]).max() == 1


def test_blocks_of_languages_and_grams_change_nothing(spark, frame, monkeypatch):
    rng = random.Random(5)
    alphabets = {f"l{k:02d}": [chr(0x4E00 + 40 * k + i) for i in range(4)] for k in range(12)}
    rows = [(i, " ".join("".join(rng.choices(alphabets[lang], k=3)) for _ in range(8)), lang)
            for i, lang in enumerate(sorted(alphabets) * 12)]
    first = sorted(map(tuple, languages(frame(rows)).collect()))
    assert sum(p == rows[i][2] for i, _, p, _ in first) > 0.95 * len(rows)
    for name, value in (("LANGUAGES", 3), ("GRAMS", 7), ("OWNERS", 5), ("CHUNK", 50)):
        monkeypatch.setattr(langid, name, value)
    assert [r[:3] for r in sorted(map(tuple, languages(frame(rows)).collect()))] == [r[:3] for r in first]


def test_memory_of_large_alphabets():
    """A text of a million characters of a large alphabet, and ten thousand short ones."""
    code = """
import random, resource
from foroscope.llm.langid import bundles, letters
rng = random.Random(1)
base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n))
assert bundles([(0, letters(text(1_000_000)))], 1).any()
assert bundles([(i, letters(text(100))) for i in range(10_000)], 10_000).any(axis=1).all()
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=600)
    assert int(done.stdout) < 500
