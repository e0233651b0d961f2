"""Licences as files hold them: wrapped notices, complete texts, texts of several licences."""

import textwrap

from data import prose

from adcube.llm import licenses
from adcube.llm.licence_texts import TEMPLATES

WHOLE = {"MIT": 5, "BSD-2-Clause": 2, "BSD-3-Clause": 3, "ISC": 3}
NOTICES = {"Apache-2.0": 2, "GPL-2.0": 2, "GPL-3.0": 2, "LGPL-3.0": 2, "AGPL-3.0": 2, "MPL-2.0": 1}
CODE = "\n".join(f"value_{k} = compute({k}, value_{k - 1})" for k in range(1, 120))


def scan(llm, files):
    rows = [(k, path, text) for k, (path, text) in enumerate(files)]
    out = licenses.scan(llm.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    assert len(out) == len(files)
    return [(r.own_licence, r.licence) for r in sorted(out, key=lambda r: r.doc_id)]


def wrapped(text, mark="", width=72):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def paragraphs(name):
    """A complete text as it is usually set: a title, a notice, clauses and disclaimer as paragraphs."""
    text = TEMPLATES[name][WHOLE[name]]
    for opening in ("The above", "1. ", "2. ", "3. ", "THE SOFTWARE IS", "THIS SOFTWARE IS"):
        text = text.replace(f" {opening}", f"\n\n{opening}", 1)
    return "Copyright (c) 2021 Jo Miller and contributors\n\n" + "\n\n".join(wrapped(p) for p in text.split("\n\n"))


def test_wrapped_notices_are_headers_of_code(llm):
    wanted, files = [], []
    for mark in ("# ", " * ", "// "):
        for name, form in {**NOTICES, **WHOLE}.items():
            wanted.append((name, name))
            files.append((f"src/{name}/{len(files)}.c", f"{wrapped(TEMPLATES[name][form], mark)}\n{mark.rstrip()}\n\n{CODE}"))
    assert scan(llm, files) == wanted


def test_complete_texts_whatever_the_file_is_called(llm):
    files = [(f"{name}/{path}", paragraphs(name)) for name in WHOLE for path in ("LICENSE", "notes.txt")]
    files += [(f"{name}/deep/er/code.py", CODE) for name in WHOLE]
    own = [(name, name) for name in WHOLE for _ in range(2)]
    assert scan(llm, files) == own + [(None, name) for name in WHOLE]


def test_title_of_a_long_licence(llm):
    titles = [("Apache-2.0", 3), ("GPL-2.0", 1), ("GPL-3.0", 1), ("LGPL-3.0", 1), ("AGPL-3.0", 1), ("MPL-2.0", 2)]
    body = "\n\n".join(wrapped(prose(80, k)) for k in range(40))
    files = [(f"{name}/COPYING", f"{' ' * 20}{wrapped(TEMPLATES[name][k], ' ' * 20, 50)}\n\n{body}") for name, k in titles]
    assert scan(llm, files) == [(name, name) for name, _ in titles]


def test_bundled_texts_do_not_hide_the_project_s_own(llm):
    bundled = "\n\n".join(["GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", *(wrapped(prose(80, k)) for k in range(60))])
    assert scan(llm, [("LICENSE.txt", f"{paragraphs('BSD-3-Clause')}\n\n----\n\n{bundled}"), ("a/code.py", CODE)]) == [("BSD-3-Clause", "BSD-3-Clause"), (None, "BSD-3-Clause")]


def test_prose_about_licences_has_none(llm):
    texts = [
        "She had a driving licence\nand no car.\n\nThe copyright of the photograph was never in doubt.",
        "licence\n" * 3_000,
        "\n" * 50_000 + "public\ndomain" + "\n#" * 50_000,
        "许可 license\n\n没有\n\n",
        "\x01license\x01",
    ]
    assert scan(llm, [(f"d{k}/text", t) for k, t in enumerate(texts)]) == [(None, None)] * len(texts)


def test_a_megabyte_of_licence_paragraphs(llm):
    text = "\n\n".join(f"Part {k} of this licence: {prose(12, k)}" for k in range(9_000))
    assert len(text) > 500_000
    assert scan(llm, [("big/LICENSE", text + "\n\n" + paragraphs("ISC")), ("big/a/x", "x")]) == [("ISC", "ISC"), (None, "ISC")]
