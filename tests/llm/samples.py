"""Texts and tables that the tests share."""

FOLDER = "/root/testdata/sf0.001"
FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed, n):
    """``n`` words that follow from the seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x >> 8 & 7] + WORDS[x >> 16 & 7])
    return " ".join(out)


def odd_texts():
    """NULL, empty, blank, very long, periodic, repeated and overlapping texts."""
    shared = prose(99, 90)
    return [
        None, "", " \t\n", "x", "é" * 30, "ab " * 400, "Z" * 900, prose(1, 200), prose(1, 200),
        prose(2, 60) + " " + shared, shared + " " + prose(3, 60), prose(4, 20) + " " + shared + " " + prose(5, 9),
        prose(6, 6000), prose(6, 6000).replace("alpha", "alphx", 1), "<|endoftext|> a  b " * 9, "  a\n\n b  ",
        shared, "!! ?? ..", prose(7, 300) + " " + prose(7, 300),
    ]


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
