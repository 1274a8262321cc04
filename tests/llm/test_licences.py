from compare import compare, oracle

from payloom.llm.licences import KNOWN, bundled_texts, known_licences, licence_folder, scan_licences
from payloom.llm.queries import ORACLES, QUERIES


def test_equals_sql(spark, sf):
    assert compare(spark, oracle(sf), sf, "op10", QUERIES["op10_licences"], ORACLES["op10_licences"]) is None


def test_canonical_forms(spark, docs):
    mit = next(t for n, t in KNOWN if n == "MIT" and len(t) > 500)
    rows = [(1, mit), (2, "Copyright (c) 2024 Someone, Inc.\nAll rights reserved.\n\n" + mit.upper()), (3, mit.replace("sublicense", "sub-licence").replace(" ", "\n  ")),
            (4, mit + " And more."), (5, "  copyright © 1999 X\r\n" + mit.replace(",", " ; ")), (6, None), (7, ""), (8, "Copyright 2020 A"), (9, "!!!"), (None, mit), (1, mit),
            (10, "released UNDER the mit licence"), (11, "The copyright notice stays"), (12, "word " * 300000)]
    got = {(r.doc_id, r.licence) for r in scan_licences(docs(rows), known_licences(spark)).collect()}
    assert got == {(1, "MIT"), (2, "MIT"), (3, "MIT"), (4, None), (5, "MIT"), (6, None), (7, None), (8, None), (9, None), (None, "MIT"), (10, "MIT"), (11, None), (12, None)}
    assert scan_licences(docs(rows), known_licences(spark)).count() == len(rows)
    assert scan_licences(docs([]), known_licences(spark)).count() == 0
    assert scan_licences(docs([(1, mit)]), known_licences(spark).limit(0)).first().licence is None


def test_full_texts_and_usual_variants(spark, docs, tmp_path):
    mit, texts = next(t for n, t in KNOWN if n == "MIT" and len(t) > 500), bundled_texts()
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= {n for n, _ in texts}
    rows = [(k, t) for k, (_, t) in enumerate(texts)] + [(100 + k, "  ".join(t.replace('"', "\u201d").split(" ")).replace("'", "\u2019")) for k, (_, t) in enumerate(texts)]
    holders = ("Copyright Joyent, Inc. and contributors", "Copyright: the authors", "COPYRIGHT The Someone Project", "\u00a9 Someone", "Copyright\u00a0by Someone", "copyright Someone")
    rows += [(200 + k, f"{h}\n\n{mit}") for k, h in enumerate(holders)]
    rows += [(300, mit.replace('"Software"', "\u201cSoftware\u201d").replace(" ", "\u00a0")), (301, "\ufeff" + mit.replace(" - ", " \u2013 ")), (302, mit.replace(" copyright", "\ncopyright").replace(" COPYRIGHT", "\nCOPYRIGHT")),
             (303, mit.replace(" ", "\n")), (400, "Copyright notice of ours"), (401, mit.replace("Software", "Program", 1))]
    got = {r.doc_id: r.licence for r in scan_licences(docs(rows), known_licences(spark)).collect()}
    for k, (name, _) in enumerate(texts):
        assert got[k] == got[100 + k] == name
    assert [got[k] for k in got if 200 <= k < 400] == ["MIT"] * (len(holders) + 4) and got[400] is got[401] is None
    (tmp_path / "Own-1.0.txt").write_text("You may use this.\nOr not.")
    own = known_licences(spark, licence_folder(spark, str(tmp_path)))
    assert scan_licences(docs([(1, "you may use this, or not")]), own).first().licence == "Own-1.0"
