"""Texts of licences: titles, notices, standard headers and whole licences.

``licenses`` beside this file holds whole texts, by identifier. Licences without a file
there are known by their titles and notices only.
"""

from __future__ import annotations

from importlib.resources import files

_GNU = {
    "AGPL-3.0": ("Affero General Public License", "3", "19 November 2007"),
    "GPL-2.0": ("General Public License", "2", "June 1991"),
    "GPL-3.0": ("General Public License", "3", "29 June 2007"),
    "LGPL-2.1": ("Lesser General Public License", "2.1", "February 1999"),
    "LGPL-3.0": ("Lesser General Public License", "3", "29 June 2007"),
}
_CC = {
    "BY": "Attribution",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-SA": "Attribution-ShareAlike",
}
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. "
)


def gnu(name: str, version: str, date: str) -> list[str]:
    first = (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        f"{name} as published by the Free Software Foundation; either version {version} of the License, or "
        "(at your option) any later version."
    )
    exact = first.replace("either version", "version").replace(", or (at your option) any later version", "")
    rest = (
        " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        f"{name} for more details."
    )
    return [
        f"GNU {name} Version {version}, {date}",
        f"GNU {name}",
        f"GNU {name} version {version}",
        f"This work is licensed under the GNU {name}, version {version}.",
        f"Licensed under the GNU {name} v{version} or later.",
        first,
        exact,
        first + rest,
    ]


def texts() -> list[tuple[str, str]]:
    """(license, text), several of each licence."""
    out = [(name, text) for name, parts in _GNU.items() for text in gnu(*parts)]
    for short, long in _CC.items():
        for version in ("3.0", "4.0"):
            name = f"CC-{short}-{version}"
            out += [
                (name, f"Licensed under CC {short} {version}."),
                (name, f"Creative Commons {long} {version} International"),
                (name, f"Licensed under the Creative Commons {long} license, CC {short} {version}."),
                (name, f"This work is licensed under a Creative Commons {long} {version} International License."),
                (name, f"This work is licensed under the Creative Commons {long} {version} International License. To "
                 f"view a copy of this license, visit http://creativecommons.org/licenses/{short.lower()}/{version}/."),
            ]
    apache = (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    )
    apache_rest = (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License."
    )
    mpl = (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    )
    mit_rest = (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software. "
    )
    out += [
        ("Apache-2.0", "Apache License"),
        ("Apache-2.0", "Apache License Version 2.0, January 2004"),
        ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
        ("Apache-2.0", apache),
        ("Apache-2.0", apache + apache_rest),
        ("MPL-2.0", "Mozilla Public License Version 2.0"),
        ("MPL-2.0", mpl),
        ("MPL-1.1", "Mozilla Public License Version 1.1"),
        ("MIT", "MIT License"),
        ("MIT", "The MIT License (MIT)"),
        ("MIT", "Licensed under the MIT license."),
        ("MIT", _MIT),
        ("MIT", _MIT + mit_rest + _AS_IS),
        ("BSD-2-Clause", "BSD 2-Clause License"),
        ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
        ("BSD-2-Clause", _BSD_2 + _BSD_AS_IS),
        ("BSD-3-Clause", "BSD 3-Clause License"),
        ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
        ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
        ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_AS_IS),
        ("ISC", "ISC License"),
        ("ISC", "Licensed under the ISC License."),
        ("ISC", _ISC),
        ("Zlib", "zlib License"),
        ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
         "be held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
         "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
         "subject to the following restrictions:"),
        ("Unlicense", "The Unlicense"),
        ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
         "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
         "binary, for any purpose, commercial or non-commercial, and by any means."),
        ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
        ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
        ("EPL-2.0", "Eclipse Public License - v 2.0"),
        ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
         "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
        ("CC0-1.0", "CC0 1.0 Universal"),
        ("CC0-1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
        ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
         "rights to this work under the Creative Commons CC0 1.0 Universal public domain dedication."),
        ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
        ("Artistic-1.0", "The Artistic License"),
    ]
    return out + whole()


def whole() -> list[tuple[str, str]]:
    folder = files("propfold.llm").joinpath("licenses")
    found = sorted((f.name, f) for f in folder.iterdir() if f.name.endswith(".txt"))
    return [(name.removesuffix(".txt"), f.read_text("utf-8", "replace")) for name, f in found]
