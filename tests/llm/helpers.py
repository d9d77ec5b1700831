import random

import pandas as pd

AWKWARD = [(9001, ""), (9002, None), (9003, "One two."), (9003, "One two."), (9004, "x" * 3000), (None, "No id here at all."),
           (9005, "\n\n \t\n"), (9006, "word " * 4000)]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string, _in0 int"


def prose(rng, n):
    syllables = ["ta", "ri", "mo", "ke", "lu", "sha", "pon", "dex", "vi", "ar"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def documents(n=120, seed=5):
    """Texts with exact copies, near copies and shared passages, and the awkward rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(3, 160)) for _ in range(n)]
    passage = prose(rng, 70)
    for i in range(0, n, 6):
        words = texts[i].split()
        if i % 4 == 0:
            texts.append(texts[i])
        for _ in range(2):
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        texts.append(prose(rng, 20) + " " + passage + " " + prose(rng, 20))
    return [(i, t) for i, t in enumerate(texts)] + AWKWARD


def frame(spark, rows):
    """Documents with the usual columns and some whose names clash with operators' own."""
    full = [(i, t, "en", None if k % 7 == 0 else f"s{k % 5}", len(t or ""), 1, "x", 2) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOC_SCHEMA)


def plain(df, *cols):
    pdf = df.select(*cols).toPandas().astype(object)
    pdf = pdf.where(pd.notna(pdf), None)
    return sorted(((tuple(int(v) if isinstance(v, float) and v == int(v) else v for v in r))
                   for r in pdf.itertuples(index=False)), key=repr)
