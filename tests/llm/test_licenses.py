"""License scans: against brute force over all words and all substrings, and the odd inputs."""

import random
import re

import regex

from parley.llm.licenses import NOTICES, PHRASES, Notice, Scanner, label_columns, with_licenses


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_base(text):
    words, out = words_of(text), []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        out += [(label, i) for i in range(len(words)) if words[i : i + len(p)] == p]
    return words, out


ODD = [
    None, "", " ", "Under the MIT License", "under the mit license under the mit license", "CC-BY-NC cc by\nnc CC/BY/NC",
    "Apache License, Version 2.0; apache license version 20", "Licensed under the Apache Licence, Version 2.0.",
    "relased under teh MIT license", "É under the mit license é", "under\x00the\x7fmit`license", "x " * 20000 + "cc by nc",
    "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "under the GNU General Public License, version 3.",
    "a license", "cc by nc" * 3, "under the mit licenses",
]


def frame(spark, texts):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "cc by nc", None, None)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, labels string")


def test_base_columns_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [*"under the mit license apache version 2 cc by nc".split(), "X,", "é", "\n"]
    texts = ODD + [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(300)]
    df = with_licenses(frame(spark, texts)).drop("labels")
    rows = df.select("*", *[c.alias(n) for n, c in label_columns().items()]).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        words, base = plain_base(r.text)
        at = [i for _, i in base]
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        labels = sorted({b for b, _ in base})
        assert r.base_labels == ",".join(labels) and set(labels) <= set(filter(None, r.labels.split(",")))
        assert r.score == 1.0 if base else 0 <= r.score <= 1


def test_near_notices_are_found_with_their_places(spark):
    rows = with_licenses(frame(spark, ODD)).collect()
    spans = {r.text: r.license_spans for r in rows}
    of = lambda t: {s.label for s in spans[t]}
    assert of("Licensed under the Apache Licence, Version 2.0.") == {"apache-2"}
    assert of("relased under teh MIT license") == {"mit"}
    assert of("Licensed under CC BY-NC 4.0.") == {"cc-by-nc"} and of("Licensed under CC BY-SA 4.0.") == {"cc-by-sa"}
    assert of("under the GNU General Public License, version 3.") == {"gpl-3"}
    assert of("a license") == set() and of("under the mit licenses") == {"mit"}
    s = spans["relased under teh MIT license"][0]
    assert (s.first_word, s.end_word) == (0, 5) and 0.9 <= s.similarity < 1


def test_seeds_lose_no_occurrence():
    """Where the pattern matches in a whole text, some seed leads there."""
    rng = random.Random(8)
    for text, label in NOTICES.items():
        notice = Notice(text, label, 0.1)
        for _ in range(15):
            spoilt = list(text)
            for _ in range(rng.randint(0, notice.edits + 2)):
                i = rng.randrange(len(spoilt))
                spoilt[i] = rng.choice(["", "q", spoilt[i] + "ß"])
            line = " " + " ".join(rng.choices(["and", "the", "öl"], k=9)) + " " + "".join(spoilt) + " of the end "
            whole = regex.search(f"(?b)(?:{regex.escape(text, special_only=True)}){{e<={notice.edits}}}", line)
            found = notice.find(line.encode())
            assert bool(found) == bool(whole)
            if whole:
                assert min(e for _, _, e in found) <= sum(whole.fuzzy_counts)


def test_notices_of_unequal_quality_in_one_window():
    """A weaker notice before, between and behind closer ones is found, and its label stays."""
    notice, weak, good = Notice("under the mit license", "mit", 0.1), "under the mot license", "under the mit license"
    for order in ([weak, good], [good, weak], [weak, good, weak, good], [weak, weak], [weak, "undr the mot license", good]):
        line = " foo " + " and then ".join(order) + " foo "
        found = notice.find(line.encode())
        assert [e for _, _, e in found] == [{weak: 1, good: 0}.get(o, 2) for o in order]
        assert [line[b:e] for b, e, _ in found] == order
    text = "under the gnu generel publik licence version 2 and that part is under the gnu general public license version 3"
    spans = Scanner(PHRASES, NOTICES, 0.1).scan(text.encode())[1]
    assert [(s[0], s[1], s[3]) for s in spans] == [("gpl-2", 0, 3), ("gpl-3", 12, 0)]


def test_empty_table_and_no_notices(spark):
    assert with_licenses(frame(spark, ODD).where("false")).count() == 0
    assert Scanner({}, {}, 0.1).scan(b"cc by nc") == (3, [])


def test_query_on_the_table(spark):
    from conftest import SF
    from parley.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_license_scan"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        words, base = plain_base(docs[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(base), ",".join(sorted({b for b, _ in base})))
