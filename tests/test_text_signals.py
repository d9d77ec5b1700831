import random
import re

import pytest

from ledgerlake.operators import text_signals as TS


def brute(texts, topics, risk, pos, neg):
    """One call: its turns in order, joined by a line feed."""
    tagged = []  # (token, tones of its sentence)
    for s in re.split(r"[.!?\n]+", "\n".join(texts).lower()):
        toks = re.findall(r"[^\W\d_]+", s)
        tones = (bool(set(toks) & set(risk)), bool(set(toks) & set(pos)), bool(set(toks) & set(neg)))
        tagged += [(t, tones) for t in toks]
    sums = {f"{t}_{k}": 0 for t in topics for k in TS.KINDS}
    for (a, (fr, fp, fn)), (b, _) in zip(tagged, tagged[1:]):
        for t, words in topics.items():
            h = int(f"{a} {b}" in words)
            for k, v in zip(TS.KINDS, (h, h * fr, h * fp, h * fn, h * (1 if fp else -1 if fn else 0))):
                sums[f"{t}_{k}"] += v
    n = max(len(tagged) - 1, 0)
    return {k + "_ew": (v / n if n else None) for k, v in sums.items()}


def test_transcript_signals_match_brute_force(spark):
    topics = {"cc": ("carbon tax", "sea level"), "ph": ("heat wave",)}
    risk, pos, neg = ("risk", "uncertain"), ("strong", "good"), ("loss", "weak")
    turns = [(1, 0, "Carbon tax is a risk. Sea level rises! Good heat wave"),
             (1, 1, "The carbon tax\nweak loss heat wave. sea level good"),
             (2, 0, "Nothing here"), (3, 0, "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, text string")
    out = {r.conv_id: r for r in TS.transcript_signals(df, ["conv_id"], "text", topics, risk_words=risk,
                                                       pos_words=pos, neg_words=neg).collect()}
    want = brute([t for c, _, t in turns if c == 1], topics, risk, pos, neg)
    for k, v in want.items():
        assert out[1][k] == pytest.approx(v)
    assert out[2]["cc_expo_ew"] == 0.0
    assert out[3]["cc_expo_ew"] is None  # no bigrams


def test_firm_year_mean_of_quarters(spark):
    rows = [(1, 2020, 1, 0.1), (1, 2020, 1, 0.3), (1, 2020, 2, 0.5)]
    cols = [f"{t}_{k}_ew" for t in TS.DEFAULT_TOPICS for k in TS.KINDS]
    data = [(f, y, q, *([v] * len(cols))) for f, y, q, v in rows]
    df = spark.createDataFrame(data, ["firm_id", "year", "quarter"] + cols)
    r = TS.firm_year_signals(df).first()
    assert r.cc_expo_ew == pytest.approx((0.2 + 0.5) / 2)


def test_bigrams_cross_sentences_turns_and_blocks(spark, monkeypatch):
    """Bigrams run over sentence ends, empty turns and blocks of turns; the tones are those of
    the first token's sentence."""
    monkeypatch.setattr(TS, "TURNS_PER_BLOCK", 2)
    topics = {"cc": ("sea level", "tax now", "level good"), "ph": ("heat wave", "now heat")}
    tones = {"risk_words": ("risk",), "pos_words": ("good",), "neg_words": ("loss",)}
    calls = {1: ["risk. Sea", "", None, "level. 5 % !", "...", "Good tax", "now", "heat\nwave. Sea"],
             2: ["loss tax", "now heat", "wave sea", "level good", "-", "?"],
             3: [None], 4: [""], 5: ["Sea"]}
    df = spark.createDataFrame([(c, i, t) for c, ts in calls.items() for i, t in enumerate(ts)],
                               "conv_id long, turn int, text string")
    out = {r.conv_id: r for r in TS.transcript_signals(df, ["conv_id"], topics=topics, **tones).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5]
    for c, texts in calls.items():
        want = brute([t for t in texts if t is not None], topics, *tones.values())
        assert {k: out[c][k] for k in want} == pytest.approx(want), c
    assert out[2].n_bigrams == 7 and out[5].n_bigrams == 0 and out[5].cc_expo_ew is None


def test_dictionary_joined_without_broadcast(spark):
    """The same rows whether or not the dictionary is broadcast; a bigram may belong to two topics."""
    vocab = [f"q{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    topics = {"cc": tuple(f"{x} {y}" for x, y in zip(vocab, vocab[1:])) + ("carbon tax",), "op": ("carbon tax",)}
    df = spark.createDataFrame([(1, 0, "Carbon tax qaa qab qac. nothing")], "conv_id long, turn long, text string")
    kw = dict(topics=topics, risk_words=("x",), pos_words=("y",), neg_words=("z",))
    for limit in (5_000_000, 0):
        r = TS.transcript_signals(df, ["conv_id"], max_broadcast_rows=limit, **kw).first()
        assert r.n_bigrams == 5 and r.cc_expo_ew == pytest.approx(3 / 5) and r.op_expo_ew == pytest.approx(1 / 5)


def random_calls(seed=4):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    turns = []
    for c in range(12):
        for t in range(rng.randint(1, 9)):
            text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "\n", "! ", " 12 "]) for _ in range(rng.randint(0, 25)))
            turns.append((c, t, text))
    turns += [(20, 0, ""), (20, 1, None), (21, 0, "..."), (21, 2, words[0]), (21, 4, words[1] + ".")]
    return words, turns


@pytest.mark.parametrize("limit", [0, 5_000_000])
def test_long_tone_lists_are_joined(spark, limit):
    """Lists as frames and as arguments, broadcast or not, give what brute force gives; none is in the plan."""
    words, turns = random_calls()
    rng = random.Random(9)
    lists = [tuple(rng.sample(words, 40)) + tuple(f"filler{f}{i}" for i in range(3000)) for f in "abc"]
    topics = {"cc": tuple(f"{rng.choice(words)} {rng.choice(words)}" for _ in range(3000)), "ph": (f"{words[0]} {words[1]}",)}
    df = spark.createDataFrame(turns, "conv_id long, turn long, text string")
    by_frame = TS.transcript_signals(df, ["conv_id"], "text", topics, max_broadcast_rows=limit,
                                     tone_words=TS.tone_table(spark, *lists))
    by_list = TS.transcript_signals(df, ["conv_id"], "text", topics, max_broadcast_rows=limit, risk_words=lists[0],
                                    pos_words=lists[1], neg_words=lists[2])
    plan = by_frame._jdf.queryExecution().optimizedPlan().toString()
    assert "fillera7" not in plan and "arrays_overlap" not in plan
    assert sorted(map(tuple, by_frame.collect())) == sorted(map(tuple, by_list.collect()))
    got = {r.conv_id: r for r in by_list.collect()}
    assert set(got) == {c for c, _, _ in turns}
    some = 0
    for c in got:
        want = brute([t or "" for k, _, t in turns if k == c], topics, *lists)
        for k, v in want.items():
            assert got[c][k] == pytest.approx(v)
            some += bool(v)
    assert some > 20


def test_repeated_turns_count_twice(spark):
    df = spark.createDataFrame([(1, 0, "Good carbon tax. Bad"), (1, 0, "Good carbon tax. Bad")], "conv_id long, turn long, text string")
    r = TS.transcript_signals(df, ["conv_id"], "text", {"cc": ("carbon tax",)}, pos_words=("good",)).first()
    assert r.n_bigrams == 7 and r.cc_pos_ew == pytest.approx(2 / 7)
