"""Small documents that hold the odd cases."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines int, c string, `end` int, label int"


def texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    prose = lambda n: ". ".join(line(rng.randint(3, 12)).capitalize() for _ in range(n)) + "."
    base = prose(30)
    near = base.split(" ")
    near[5] = "changed"
    passage = prose(9)
    out = [None, "", " ", "\n\n", "\n a \n", "word", "two words", "A B c", "a b C", "a  b\tc\n"]
    out += [base, base, " ".join(near), base.upper(), base + " tail", prose(3) + " " + passage + " " + prose(2), prose(4) + "\n" + passage]
    out += ["Shared Line\n" + prose(4) + "\n  shared line \t" for _ in range(11)]
    out += ["NBSP join été İstanbul Σσ it's 42 \U0001f600 你好", "x\x1cy ... !!! ###", "...", "1.\n.\n?a b"]
    out += ["same same same same same same same same same same " * 5, line(6000), prose(1500), "q" * 5000]
    out += [prose(rng.randint(1, 40)) for _ in range(40)]
    return out


def rows():
    out = []
    for i, text in enumerate(texts()):
        lang = (None, "en", "de", "fr")[i % 4]
        source = None if i % 11 == 3 else f"src{i % 3}"
        out.append((i * 7, text, lang, source, None if text is None else len(text), i, "x", i, 1))
    return out + [out[20], out[20]]
