"""Templates of public licences: short notices and the standard texts that go with them.

Fixed values: the wording is that of the licences. Names and years are left out.
"""

from __future__ import annotations

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

_BSD_ADVERTS = """All advertising materials mentioning features or use of this software must display the following acknowledgement:
This product includes software developed by the organization."""

_GPL2 = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

_MIT_0 = _MIT[: _MIT.index(", subject to")] + ". " + _MIT[_MIT.index("THE SOFTWARE IS") :]
_0BSD = _ISC[: _ISC.index(",\nprovided that")] + ". " + _ISC[_ISC.index("THE SOFTWARE IS") :]


def _library(text: str) -> str:
    return text.replace("This program", "This library")


def _gnu(text: str, kind: str) -> str:
    return text.replace("GNU General", f"GNU {kind} General")


def _creative_commons():
    parts = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    spelt = {"NC": "Non-Commercial", "SA": "Share Alike", "ND": "No Derivatives"}
    for version, scope in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic")):
        if version != "4.0":
            parts["ND"], spelt["ND"] = "NoDerivs", "No Derivs"
        for kind in ("BY", "BY-SA", "BY-NC", "BY-NC-SA", "BY-ND", "BY-NC-ND"):
            name = f"CC-{kind}-{version}"
            yield name, f"Licensed under CC {kind} {version}."
            for words in (parts, parts | spelt):
                title = "-".join(words[x] for x in kind.split("-"))
                yield name, f"This work is licensed under a Creative Commons {title} {version} {scope} License."


_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

_CC_PARTS = {"nc", "nd", "sa", "noncommercial", "sharealike", "noderivatives", "noderivs", "commercial", "share", "alike", "derivatives", "derivs"}
#: (words of a template that tell its family, words that must be matched if the template has them, words
#: that tell another licence of the family if a text has them within the notice and the template has not).
FAMILIES = [
    ({"gnu"}, {"gnu", "general", "public", "lesser", "affero"}, {"lesser", "affero"}),
    ({"cc"}, {"cc", "by", *_CC_PARTS}, _CC_PARTS),
    ({"creative", "commons"}, {"creative", "commons", "attribution", *_CC_PARTS}, _CC_PARTS),
    ({"apache"}, {"apache"}, set()),
    ({"mozilla"}, {"mozilla"}, set()),
    ({"mit"}, {"mit"}, {"attribution", "0"}),
    ({"redistributions"}, {"endorse", "advertising"}, {"endorse", "advertising"}),
]

#: (licence, template), fixed values; a licence may have several.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GPL),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("ISC", _ISC),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_NAMES} {_BSD_TAIL}"),
    ("MPL-2.0", _MPL),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # those that share most of their words with one of the above
    ("MIT-0", "Licensed under the MIT-0 License."),
    ("MIT-0", _MIT_0),
    ("0BSD", _0BSD),
    ("BSD-4-Clause", f"{_BSD_HEAD} {_BSD_ADVERTS} {_BSD_NAMES} {_BSD_TAIL}"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _GPL2),
    ("LGPL-2.0", "This work is licensed under the GNU Library General Public License, version 2."),
    ("LGPL-2.0", _gnu(_library(_GPL2), "Library")),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", _gnu(_library(_GPL2), "Lesser").replace("version 2", "version 2.1")),
    ("LGPL-3.0", _gnu(_GPL, "Lesser")),
    ("AGPL-3.0", _gnu(_GPL, "Affero")),
]
TEMPLATES += [x for x in _creative_commons() if x not in TEMPLATES]
