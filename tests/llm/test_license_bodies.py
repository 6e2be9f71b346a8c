import textwrap
from pathlib import Path

import pytest

from llm_fixtures import docs  # noqa: F401
from siftworks.llm import licenses
from siftworks.llm.license_texts import DIGESTS, TEXTS

COMMON = Path("/usr/share/common-licenses")
CLAUSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))


def test_whole_texts_in_any_wrapping_and_with_other_titles(spark, docs):
    bsd3 = TEXTS["BSD-2-Clause"].replace("\n\nTHIS", f"\n\n{CLAUSE}\n\nTHIS")
    texts = {**TEXTS, "BSD-3-Clause": bsd3}
    forms = [(n, f) for n, t in texts.items() for f in [t, *[wrapped(t, w) for w in (60, 72, 78)]]]
    # the published wrapping, whose third line starts with the word
    isc = TEXTS["ISC"].replace("provided that the above copyright", "provided that the above\ncopyright").replace("<year> <owner>", "(c) 2020, Some One")
    assert "\ncopyright notice and" in isc
    forms += [("ISC", isc), ("ISC", isc.replace("ISC License\n", "")), ("ISC", isc.replace("and/or distribute", "and distribute"))]
    forms += [("MIT", TEXTS["MIT"].replace("MIT License", t)) for t in ("", "The MIT License (MIT)", "# MIT")]
    forms += [("BSD-3-Clause", f"BSD 3-Clause License\n\n{bsd3}"), ("BSD-2-Clause", f"The 2-Clause BSD License\n\n{TEXTS['BSD-2-Clause']}")]
    forms += [(None, isc + "\nand more"), (None, "The MIT License"), (None, TEXTS["MIT"].replace("sublicense, ", ""))]
    got = {r.doc_id: r.license for r in licenses.scan(docs(*enumerate(f for _, f in forms))).collect()}
    assert [got[i] for i in range(len(forms))] == [n for n, _ in forms]


@pytest.mark.skipif(not COMMON.exists(), reason="no license texts here")
def test_published_texts(spark, docs):
    files = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0"}
    forms = []
    for name, file in files.items():
        text = (COMMON / file).read_text()
        forms += [(name, text), (name, "\n\n".join(" ".join(p.split()) for p in text.split("\n\n")))]
    got = {r.doc_id: r.license for r in licenses.scan(docs(*enumerate(f for _, f in forms))).collect()}
    assert [got[i] for i in range(len(forms))] == [n for n, _ in forms] and files.keys() <= DIGESTS.keys()
