import pytest

from orderlake.llm import license_scan as L


def names(text):
    t = L.Templates()
    found = sorted((-share * len(t.words[k]), t.names[k]) for _, k, share, _, _ in L.scan_texts(t, [text.encode()]))
    return [n for _, n in found]


@pytest.mark.parametrize("line, name", [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("Licensed under the ISC License.", "ISC"),
    ("// SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0"),
    ("SPDX-License-Identifier: MIT-0", "MIT-0"),
    ("SPDX-License-Identifier: CC-BY-NC-4.0", "CC-BY-NC-4.0"),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007", "AGPL-3.0"),
    ("Licensed under the Eclipse Public License, Version 2.0.", "EPL-2.0"),
    ("released under CC0 1.0 Universal", "CC0-1.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
])
def test_most_covered_notice_has_the_right_name(line, name):
    assert names(f"some text. {line} more text")[:1] == [name]


@pytest.mark.parametrize("line", [
    "This work is licensed under the GNU General Public License, version 4.", "Licensed under CC BY-XX 4.0.", "Licensed under CC BY-NC 3.0.",
    "Licensed under the Apache License, Version 1.1.", "Licensed under the Foo License.", "SPDX-License-Identifier: Apache-1.1",
])
def test_other_names_and_versions_get_no_name(line):
    assert names(f"some text. {line} more text") == []


def test_words_that_are_no_name_may_still_differ():
    assert names("This work was licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
