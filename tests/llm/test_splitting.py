import re
from math import floor

import pytest

from filigree.llm import splitting as S

C8 = S.Config("c", max_tokens=8, overlap_tokens=2, min_tokens=2)


def _size(text, c):
    return floor(len(re.findall(r"[^ \t\r\n]+", text)) * c.tokens_per_word)


def _check(pieces, texts, configs, byte=False):
    """Pieces cover every word in order, within the limit, repeating the overlap."""
    by = {}
    for p in pieces:
        by.setdefault((p.key, p.config_name), []).append(p)
    for c in configs:
        for key, text in texts.items():
            got = sorted(by.pop((key, c.name), []), key=lambda p: p.piece)
            if not text or _size(text, c) <= c.max_tokens:
                assert not got
                continue
            words = [m.span() for m in re.finditer(r"[^ \t\r\n]+", text)]
            assert [p.piece for p in got] == list(range(len(got)))
            done = 0
            for p in got:
                assert p.piece_text == (text.encode()[p.start_char : p.end_char].decode() if byte else text[p.start_char : p.end_char])
                assert _size(p.piece_text, c) <= c.max_tokens
                assert p.start_word + p.overlap_words == done
                assert p.overlap_words <= c.words(c.overlap_tokens)
                if done >= c.words(c.overlap_tokens) and p.piece:
                    assert p.overlap_words == c.words(c.overlap_tokens)
                if not byte:
                    assert (p.start_char, p.end_char) == (words[p.start_word][0], words[p.end_word - 1][1])
                done = p.end_word
            assert done == len(words)
    assert not by


TEXTS = {
    1: "One two three. Four five six seven eight nine ten.\n\nEleven twelve thirteen fourteen fifteen sixteen.\n# Heading here\nseventeen eighteen nineteen twenty",
    2: None, 3: "", 4: " \n\t ", 5: "a b c", 6: "z" * 5000, 7: " ".join(f"w{i}" for i in range(300)), 8: "été naïve 中文 " * 40, 9: "x\r\n\r\ny " * 60, 10: "one two three four five six seven eight",
}


def _table(spark, texts):
    return spark.createDataFrame([(k, t, "clash", 1) for k, t in texts.items()], "key bigint, text string, piece string, part int")


@pytest.mark.parametrize("range_bytes", [1 << 22, 200, 64, 7])
def test_round_trip(spark, range_bytes):
    configs = [C8, S.Config("d", 20, 5, 4, 1.33)]
    got = S.split(_table(spark, TEXTS), ["key"], "text", configs, range_bytes=range_bytes).collect()
    _check(got, TEXTS, configs)


def test_natural_boundaries_first(spark):
    text = "a b c d e f.\n\ng h i j k. l m n o p q r s"
    got = sorted(S.split(_table(spark, {1: text}), ["key"], "text", [C8]).collect(), key=lambda p: p.piece)
    assert got[0].piece_text == "a b c d e f." and got[0].boundary == "paragraph"
    assert got[1].boundary == "sentence" and got[-1].boundary == "end"


def test_refused_and_empty(spark):
    with pytest.raises(ValueError):
        S.split(_table(spark, TEXTS), ["key"], "text", [S.Config("x", 5, 5)])
    assert S.split(spark.createDataFrame([], "key bigint, text string"), ["key"], "text", [C8]).count() == 0


def test_repeated_rows(spark):
    df = _table(spark, {7: TEXTS[7]})
    one, two = (S.split(d, ["key"], "text", [C8]).count() for d in (df, df.union(df)))
    assert two == 2 * one


def test_files_by_ranges(spark, tmp_path):
    text = "\n\n".join(" ".join(f"wörd{i}.{j}" for j in range(23)) + "." for i in range(400))
    (tmp_path / "big.txt").write_bytes(text.encode())
    (tmp_path / "small.txt").write_text("a b c")
    configs = [S.Config("c", 40, 6, 5)]
    got = S.split_files(spark, str(tmp_path), configs, range_bytes=4096).collect()
    rows = [r for r in got if r.path.endswith("big.txt")]
    assert len(rows) == len(got)

    class Row:
        def __init__(self, r):
            self.__dict__.update(r.asDict(), key=1)

    _check([Row(r) for r in rows], {1: text}, configs, byte=True)


#: Better breaks only beyond the halo of a cut, none at all for a while, blanks longer than the halo, words about as long.
UNEVEN = {
    1: "a bc def\n" * 30 + "\n" + "a bc def\n" * 40, 2: "ab cd. " * 30 + "\n\n# x " + "ab cd. " * 40, 3: "ab " * 60 + "cd. ef\n" * 5 + "gh " * 90, 4: ("ab cd" + " " * 150) * 6, 5: " " * 90 + "ab cd\n" * 9 + "\n" * 170 + "é. ï " * 50,
    6: ("x" * 35 + " ab\n") * 20, 7: "\n".join("中文 " * (i % 7) + "y" for i in range(90)),
}


@pytest.mark.parametrize("range_bytes,halo", [(200, 40), (64, 4), (5, 4), (1, 4)])
def test_pieces_do_not_depend_on_ranges(spark, range_bytes, halo):
    configs = [S.Config("c", 8, 2, 2), S.Config("least", 30, 0, 20)]
    # texts above the range are cut in ranges
    whole, got = (sorted(S.split(_table(spark, UNEVEN), ["key"], "text", configs, range_bytes=r, halo=h).collect()) for r, h in ((1 << 20, 4), (range_bytes, halo)))
    assert got == whole
    _check(got, UNEVEN, configs)


def test_a_halo_too_small_is_refused(spark):
    with pytest.raises(ValueError):
        S.split(_table(spark, TEXTS), ["key"], "text", [C8], halo=1)


def test_files_with_distant_blank_lines(spark, tmp_path):
    text = ("wörd wörd\n" * 300 + "\n") * 3
    (tmp_path / "big.txt").write_bytes(text.encode())
    got = S.split_files(spark, str(tmp_path), [S.Config("c", 40, 6, 5)], range_bytes=2048).orderBy("piece").collect()
    assert got[-1].end_word == len(text.split()) and all(b.start_word + b.overlap_words == a.end_word for a, b in zip(got, got[1:]))
    assert all(text.encode()[p.start_char : p.end_char].decode() == p.piece_text for p in got)
    assert all(b.start_char < a.end_char for a, b in zip(got, got[1:]))
