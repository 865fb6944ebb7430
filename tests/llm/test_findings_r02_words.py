"""Cases of the finding on decontamination in FINDINGS_r02.md."""

from __future__ import annotations

import numpy as np

from quern.llm import decontamination


def test_f2_properties_of_words_are_the_same_on_the_short_way():
    v = decontamination.Vocabulary()
    words = [b"plain", b"Paris", b"Paris,", b"end.", b"km", b"KM.", b"NASA!", b"x", b"A", b"?", b"...", b"3,5", b"$7%", b"it's", b"(word)", "École".encode(), "тест.".encode(), b"w\xff", decontamination.BREAK, b"a..", b"semi;", b"<num>"]
    ids = [v[w] for w in words]
    v.settle()
    for i, w in zip(ids, words, strict=True):
        text = w.decode("utf-8", "replace")
        core = text if text.isalnum() else decontamination.EDGE.sub("", text)
        low = core.lower()
        plain = "<num>" if not core.isalpha() and decontamination.NUMBER.match(core) else "<unit>" if low in decontamination.UNITS else low
        inside = "<name>" if plain == low and len(core) > 1 and core[0].isupper() and core[1:].islower() else plain
        ends = not text.isalnum() and (w == decontamination.BREAK or bool(decontamination.SENTENCE_END.search(text)))
        void = not text.isalnum() and (w == decontamination.BREAK or not core)
        low2, inside2, plain2, flags = decontamination.properties(w)
        assert (low2, inside2, plain2) == (low, inside, plain), w
        assert [bool(flags & f) for f in (decontamination.INSIDE, decontamination.FIRST, decontamination.ENDS, decontamination.VOID)] == [inside[:1] != "<", plain[:1] != "<", ends, void], w
        assert v.flags[i] == flags and v.first[i] == decontamination.xxhash.xxh3_64_intdigest(plain) and v.exact[i] == decontamination.xxhash.xxh3_64_intdigest(low)


def test_f2_no_form_is_made_that_finds_nothing(monkeypatch):
    made, hashes = [], decontamination.Template.hashes

    def counted(self, *a, **k):
        made.append(np.shape(out := hashes(self, *a, **k)))
        return out

    words = b"which of these seven old wooden bridges crosses the river near that small town in spring"
    matcher = decontamination.Matcher([(1, words)])
    monkeypatch.setattr(decontamination.Template, "hashes", counted)
    assert matcher.find(b"Ask: " + words + b"? Nobody knows.")[1][0] == 16
    assert made[0][0] == 3
    assert decontamination.Matcher([(1, b"1 2 3 4 5 6 7 8 9 10 11 12 13 14")]).find(b"so 1 2 3 4 5 6 7 8 9 10 11 12 13 14 it is")
    assert made[-1][0] == 4 or made[-2][0] == 4
