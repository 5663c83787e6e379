from thermocline.llm import line_dedup


def plain(rows, ratio, least):
    """The same by loops."""
    pages, total = {}, {}
    for _, text, host in rows:
        total[host] = total.get(host, 0) + 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""} if text is not None else set():
            pages[host, line] = pages.get((host, line), 0) + 1
    gone = {k for k, n in pages.items() if n >= least and n > ratio * total[k[0]]}
    out = []
    for key, text, host in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if (host, x.strip(" ")) not in gone]
        out.append((key, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_as_loops(spark, make_docs):
    rows = [(k, f"menu\n\n own {k} \nshared" if k % 2 else f" menu \nown {k}", "h1") for k in range(40)]
    rows += [(100 + k, f"menu\nrare {k}", "h2") for k in range(3)]
    rows += [(200 + k, "copy of all\nline two", None) for k in range(12)]
    rows += [(300, None, "h1"), (301, "", "h1"), (302, "menu\nmenu\nmenu", "h1"), (303, "x\n" * 20_000, "h1"), (300, None, "h1"), (None, "menu", "h1")]
    docs = make_docs(rows)
    out = line_dedup.drop_boilerplate(docs, ratio=0.3, min_pages=5)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()), key=str)
    assert got == plain(rows, 0.3, 5)
    # the border itself stays: more than the ratio is asked for
    half = [(k, "a\nown %d" % k if k < 10 else "own %d" % k, "h") for k in range(20)]
    assert all(r["n_dropped"] == 0 for r in line_dedup.drop_boilerplate(make_docs(half), ratio=0.5, min_pages=2).collect())
    assert line_dedup.drop_boilerplate(make_docs([])).count() == 0
    list_rows = line_dedup.boilerplate(docs, ratio=0.3, min_pages=5).collect()
    assert {(r["host"], r["line"]) for r in list_rows} == {("h1", "menu"), ("h1", "shared"), (None, "copy of all"), (None, "line two")}
