"""Labels and shares of whole licences against a plain search over every place."""

import math
import re

from plain import words
from test_models import SF_DIR

from floodplan.llm import licences
from floodplan.llm.licence_texts import NOTICES, WHOLE
from floodplan.llm.queries import op2_licences

WORDINGS = {**NOTICES, **WHOLE}


def plain_scan(texts):
    """(n_base, first, last, base_labels, labels, score) of every text."""
    parts = {
        label: [[words(p) for p in line.split("*")] for line in text.split("\n") if line.strip()]
        for label, text in WORDINGS.items()
    }
    vocabulary = {w for clauses in parts.values() for clause in clauses for part in clause for w in part}
    split = [words(t) for t in texts]
    idf = {w: 1 + math.log((len(texts) + 1) / (sum(w in set(s) for s in split) + 1)) for w in vocabulary}
    found = []
    for text in split:
        places, base, told = [], set(), {}
        for label, clauses in parts.items():
            shares, weights = [], []
            for before, phrase, after in clauses:
                whole = before + phrase + after
                at = [s for s in range(len(text)) if text[s : s + len(phrase)] == phrase]
                inside = [
                    sum(idf[w] for k, w in enumerate(whole) if 0 <= (p := s - len(before) + k) < len(text) and text[p] == w)
                    for s in at
                ]
                weights.append(sum(idf[w] for w in whole))
                shares.append(max(inside, default=0.0))
                if licences.BASE.get(label) == " ".join(phrase):
                    places += at
                    base |= {label} if at else set()
            share = sum(shares) / sum(weights)
            if shares[0] and (label in base or share >= licences.SHARE):
                told[label] = share
        found.append(
            (len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
             ",".join(sorted(told)), round(max(told.values(), default=0.0), 9))
        )
    return found


def rows(table):
    return {
        r.doc_id: (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
        for r in licences.licence_scan(table).collect()
    }


def wording(label):
    return re.sub(r"[*]|\n\s+", " ", WORDINGS[label])


def test_against_every_place(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    mit, bsd = wording("mit-text"), wording("bsd")
    planted = {
        "mit": "before it " + mit + " after it",
        "upper": mit.upper(),
        "half": mit[: len(mit) // 4],
        "renamed": mit.replace("Software", "Program"),
        "headless": mit.replace("free of charge", "free"),
        "bsd": bsd,
        "bsd-3": bsd + wording("bsd-3-clause"),
        "both": wording("zlib") + mit + mit,
        "turned": " ".join(reversed(words(mit))),
        "notice": "see the lesser general public license and the mozilla public license apache license",
        "none": None,
        "empty": "",
        "long": "permission license public " * 30_000 + wording("isc") + " mit license" * 20_000,
    }
    texts += planted.values()
    table = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, hits string, starts int"
    )
    found, want = rows(table), plain_scan(texts)
    assert found == dict(enumerate(want))
    told = dict(zip(planted, [w[4] for w in want[-len(planted) :]]))
    assert told["mit"] == told["upper"] == told["renamed"] == "mit-text" and told["both"] == "mit-text,zlib"
    assert told["half"] == told["headless"] == told["turned"] == told["none"] == told["empty"] == ""
    assert (told["bsd"], told["bsd-3"], told["long"]) == ("bsd", "bsd,bsd-3-clause", "isc,mit")


def test_repeated_rows_and_licences_told(spark):
    text = "intro " + wording("unlicense")
    table = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    found = licences.licence_scan(table).collect()
    assert len(found) == 3
    assert {tuple(r.licences[0])[:2] + (r.licences[0].first_word,) for r in found} == {("unlicense", False, 3)}
    assert all(len(r.licences) == 1 and r.licences[0].share == 1.0 and r.score == 1.0 for r in found)


def test_query_has_digest_columns_only(spark):
    assert "licences" not in op2_licences(spark, SF_DIR).columns
