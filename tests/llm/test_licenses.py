import random
import re

import pytest
from pyspark.sql import functions as F

from event_ml.llm import licenses

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def pattern_of(template):
    """The template as one regular expression over words that each end with a blank."""
    out = []
    for part in re.split(r"(<<[^<>]*>>)", template):
        if part == "<<optional>>":
            out.append("(?:")
        elif part == "<<end>>":
            out.append(")?")
        elif part.startswith("<<"):
            low, high, match = re.fullmatch(r"<<var;words=(\d+)-(\d+)(?:;match=(.*))?>>", part).groups()
            out.append(f"(?:(?:{match or '[^ ]+'}) ){{{low},{high}}}")
        else:
            out.extend(re.escape(w) + " " for w in words_of(part))
    return re.compile("".join(out))


def slow_scan(text, templates, base):
    words = words_of(text)
    found = [(label, i, i + len(words_of(p))) for p, label in base for i in range(len(words)) if words[i : i + len(words_of(p))] == words_of(p)]
    accepted = []
    for label, template in templates:
        pattern = pattern_of(template)
        first = words_of(re.split("<<", template)[0])[0]
        for i in range(len(words)):
            if words[i] == first:
                ends = [j for j in range(i + 1, min(len(words), i + 400) + 1) if pattern.fullmatch(" ".join(words[i:j]) + " ")]
                accepted += [(label, i, max(ends))] if ends else []
    key = lambda x: (x[1], x[2], x[0])
    return len(words), sorted(found, key=key), sorted(accepted, key=key)


def check(scanner, text, templates, base):
    n, found, accepted, score = scanner.scan(text)
    assert (n, found, accepted) == slow_scan(text, templates, base), text
    assert 0 <= score <= 1 and (score == 1) >= bool(accepted) and score >= 0.5 * bool(found)
    return accepted, score


def random_template(rng, depth=0):
    parts = [rng.choice("abc")] if not depth else []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.25 and depth < 2:
            parts.append("<<optional>>" + random_template(rng, depth + 1) + "<<end>>")
        elif kind < 0.45:
            low = rng.randint(0, 2)
            parts.append(f"<<var;words={low}-{low + rng.randint(0, 2)}{rng.choice(['', ';match=[ab]+'])}>>")
        else:
            parts.append(rng.choice("abc"))
    return " ".join(parts)


def test_automata_against_regular_expressions():
    rng = random.Random(7)
    for _ in range(150):
        templates = [(f"t{i}", random_template(rng)) for i in range(3)]
        base = [("a b", "ab"), ("a a", "aa"), ("c", "c")]
        scanner = licenses.Scanner(templates, base)
        for _ in range(6):
            check(scanner, " ".join(rng.choice("aabc") for _ in range(rng.randint(0, 14))), templates, base)


def test_wording_of_licenses():
    scanner = licenses.Scanner(licenses.TEMPLATES, tuple(licenses.BASE.items()))
    labels = lambda text: {x[0] for x in scanner.scan(text)[2]}
    base = lambda text: {x[0] for x in scanner.scan(text)[1]}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by-nc-notice"} and base("Licensed under CC BY-NC 4.0.") == {"cc-by"}
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-notice"}
    assert labels("x licensed under the terms of the GNU General Public License version 2") == {"gpl-notice"}
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache-2.0-notice"}
    assert labels("Released under the MIT License.") == {"mit-notice"} and labels("Released under the XMIT License.") == set()
    for label, template in licenses.TEXTS.items():
        text = re.sub(r"<<optional>>|<<end>>", "", re.sub(r"<<var;words=(\d+)-\d+(;match=[^<>]*)?>>", lambda m: " 3" * max(1, int(m[1])), template))
        bare = template
        while "<<optional>>" in bare:
            bare = re.sub(r"<<optional>>((?!<<optional>>).)*?<<end>>", "", bare, flags=re.S)
        bare = re.sub(r"<<var;words=(\d+)-\d+(;match=[^<>]*)?>>", lambda m: " 7" * int(m[1]), bare)
        for own in (text, bare, "one two\n * " + bare.replace("\n", "\n * ").upper() + " three"):
            assert label in labels(own), (label, own)
        # a word changed, or one more: not accepted (next to a replaceable region it may be)
        words = text.split()
        for at in range(3, len(words) - 9, 7):  # a template may end with an optional region
            if words_of(words[at]) and "3" not in words[at - 2 : at + 3]:
                for other in (["changed"], [words[at], "more"]):
                    own, _, accepted, score = scanner.scan(" ".join(words[:at] + other + words[at + 1 :]))
                    assert label not in {x[0] for x in accepted} and score >= 3 / len(words_of(text)), (label, at, other)


def test_op13_against_brute_force(spark, small_dir, texts):
    got = {r.doc_id: r for r in licenses.op13_template_markup(spark, small_dir).collect()}
    assert got.keys() == texts.keys()
    labelled = 0
    for doc, text in texts.items():
        n, found, accepted = slow_scan(text, licenses.TEMPLATES, tuple(PHRASES.items()))
        r, starts = got[doc], [x[1] for x in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(found), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x[0] for x in found})) and r.labels == ",".join(sorted({x[0] for x in found + accepted}))
        assert (r.score == 1) == bool(accepted) or 0 < r.score <= 1
        labelled += bool(accepted)
    assert labelled


def test_places_of_odd_rows(spark, odd_docs, no_docs):
    odd = odd_docs.withColumn("labels", F.lit("x")).withColumn("places", F.lit(1)).withColumn("n_words", F.lit("y"))
    more = [(20, "MIT license MIT License, cc-by cc_byé cc by"), (20, "MIT license MIT License, cc-by cc_byé cc by"), (21, "word " * 50_000 + "released under the mit license")]
    rows = spark.createDataFrame(more, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    got = {}
    for r in licenses.scan(rows).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [x.past for x in got[20][0].base_places] == [2, 4, 6, 10] and got[20][0] == got[20][1]
    assert [(x.label, x.first) for x in got[21][0].places] == [("mit-notice", 50_000)]
    for doc in (2, 3, 4):
        assert (got[doc][0].n_words, got[doc][0].base_places, got[doc][0].places, got[doc][0].score) == (0, [], [], 0.0)
    assert got[None][0].n_words == 12 and licenses.scan(odd).count() == odd.count()
    assert licenses.scan(no_docs).count() == 0


@pytest.mark.parametrize("template", ["<<optional>>a<<end>> b", "<<var;words=1-2>> a", "a <<optional>> b", "a <<end>>", "a <<var;words=3-2>>", "a <<other>>", ""])
def test_wrong_markup_is_an_error(template):
    with pytest.raises(ValueError):
        licenses.Automaton("x", template)
