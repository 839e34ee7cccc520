"""Small tables with every odd case, and plain brute-force forms of what operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id string, xh string, n string, fp string, row string, size string, u string, tokens string, c string, l string, m string"
)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def make_docs() -> list[tuple]:
    """(doc_id, text, lang, source): near and exact copies, shared passages, a chain of edits, odd texts."""
    r = random.Random(3)
    vocab = {
        lang: ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(400)]
        for lang, parts in {"en": ["th", "er", "on", "ing", "wh"], "fr": ["eau", "é", "ç", "oi", "que"], "ru": ["шк", "ов", "ны", "пре", "ж"]}.items()
    }

    def prose(lang: str, n: int) -> str:
        out = []
        while len(out) < n:
            out += [" ".join(r.choice(vocab[lang]) for _ in range(r.randint(4, 12)))]
        return "\n".join(out[: max(1, n // 8)])

    rows: list[tuple] = []
    passage = prose("en", 160)
    for i in range(60):
        lang = r.choice(["en", "fr", "ru"])
        text = prose(lang, r.choice([16, 80, 240, 800]))
        if i % 5 == 0:
            text = text + "\n" + passage + "\n" + prose(lang, 40)
        rows.append((i, text, lang, r.choice(["a", "b", "b", "c", None])))
    chain = words(prose("en", 900))
    for i in range(60, 90):  # a chain: neighbours are near, the ends are not
        rows.append((i, " ".join(chain), "en", "b"))
        at = r.randrange(len(chain))
        chain[at : at + 1] = [f"edit{i}"]
    star = words(prose("fr", 500))
    for i in range(90, 120):  # near copies of one text, far from each other
        w = star[:]
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"sub{r.random()}"
        rows.append((i, " ".join(w).upper() if i % 2 else " ".join(w), "fr", "a"))
    rows += [(i, rows[3][1], "en", "c") for i in range(120, 126)]
    odd = [None, "", " \n\t ", "a", "A b c", "a b c d", "x " * 3000, "ab" * 6000, "\n" * 50, "é", "1 2 3 4 5 6 7 8 9 10 11 12", "a\x0bb\x0cc d e", "日本語 テスト", "#*$ %& |<> ###", "<|endoftext|> <s> </s> ▁▁ \x00"]
    rows += [(130 + i, t, None, "odd") for i, t in enumerate(odd)]
    rows += [(150, "long " + " ".join(str(r.randrange(10**6)) for _ in range(30000)), "en", "odd")]
    rows += [rows[7], rows[7], rows[64]]  # repeated rows
    return rows


def frame(spark, rows):
    data = [(i, t, lang, s, None if t is None else len(t), *(["clash"] * 11)) for i, t, lang, s in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def shingle_sets(rows, k=5):
    out = []
    for _, text, *_ in rows:
        w = lower(text or "").encode().split()
        out.append({b" ".join(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    return out


def least_reachable(ids, links):
    """Smallest id in the component of each index, given linked index pairs."""
    up = list(range(len(ids)))

    def root(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    for a, b in links:
        up[root(a)] = root(b)
    least: dict[int, int] = {}
    for a in range(len(ids)):
        least[root(a)] = min(ids[a], least.get(root(a), ids[a]))
    return [least[root(a)] for a in range(len(ids))]


def counts(rows):
    return Counter(tuple(r) for r in rows)
