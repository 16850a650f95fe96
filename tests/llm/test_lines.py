import random

from rasmlens.llm.lines import remove_shared_lines


def plain(rows, min_sites):
    """The rule, line by line."""
    sites, owner = {}, {}
    for id, text, _, site in rows:
        for line in (text or "").split("\n") if text is not None else []:
            content = line.strip(" \t\r\x0b\x0c")
            if content:
                sites.setdefault(content, set()).add(site or "")
                if id is not None:
                    owner[content] = min(id, owner.get(content, id))
    out = []
    for id, text, _, site in rows:
        if text is None:
            out.append((id, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not (
            (c := x.strip(" \t\r\x0b\x0c")) and len(sites[c]) >= min_sites and owner.get(c) != id)]
        out.append((id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def run(documents, rows, **options):
    out = remove_shared_lines(documents(rows), n_lines="count_of_lines", n_removed="gone", **options)
    assert "block" in out.columns and "fp" in out.columns
    return [tuple(r) for r in out.select("doc_id", "text", "count_of_lines", "gone").collect()]


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_against_plain(documents):
    rng = random.Random(3)
    pool = [f"line {i}" for i in range(30)]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool[:rng.randint(1, 30)]) for _ in range(rng.randint(0, 12))]
        lines = [rng.choice(["", " ", "\t"]) + x + rng.choice(["", " ", "\r"]) for x in lines]
        rows.append((i, "\n".join(lines), "en", f"s{rng.randint(0, 8)}"))
    for min_sites in (2, 5, 8, 20):
        assert sorted(run(documents, rows, min_sites=min_sites), key=key) == sorted(plain(rows, min_sites), key=key)


def test_odd_rows(documents):
    boiler = "cookies\nown words"
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, boiler, "en", "a"), (3, boiler, "en", "a"),
            (None, boiler, "en", "b"), (4, "cookies", "en", None), (5, "cookies\n\ncookies", "en", "c"),
            (None, "only here\nand there", "en", "d"), (None, "and there", "en", "e"), (6, "x" * 300_000, "en", "f")]
    got = run(documents, rows, min_sites=2)
    assert sorted(got, key=key) == sorted(plain(rows, 2), key=key)
    assert got.count((3, boiler, 2, 0)) == 2  # the owner's rows keep the line
    assert (4, "", 1, 1) in got and (5, "", 3, 2) in got


def test_threshold_is_exact_with_coarse_sketches(documents):
    """With 16 registers nearly every line is near the threshold and is counted exactly."""
    rows = [(i * 100 + s, f"line {i}\nown {i} {s}", "en", f"site {s}") for i in range(30) for s in range(i + 1)]
    got = run(documents, rows, min_sites=12, lg_k=4)
    assert sorted(got, key=key) == sorted(plain(rows, 12), key=key)


def test_empty(documents):
    assert run(documents, []) == []
