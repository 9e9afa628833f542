"""Texts of common licences and of their short notices; long ones are files of ``texts``."""

from __future__ import annotations

from pathlib import Path

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n"
)
_BSD_CLOSING = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_DISCLAIMS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)

#: (licence, full text).
FULL = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
            "the Software.\n" + _AS_IS),
    ("BSD-2-Clause", _BSD_OPENING + _BSD_CLOSING),
    ("BSD-3-Clause", _BSD_OPENING + _BSD_THIRD + _BSD_CLOSING),
    ("ISC", _PERMISSION + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _DISCLAIMS),
    ("0BSD", _PERMISSION + ".\n" + _DISCLAIMS),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software.\n"
             "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
             "alter it and redistribute it freely, subject to the following restrictions:\n"
             "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
             "software. If you use this software in a product, an acknowledgment in the product documentation would be "
             "appreciated but is not required.\n"
             "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
             "software.\n"
             "3. This notice may not be removed or altered from any source distribution."),
]

#: Titles that may stand before a full text.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License"],
    "ISC": ["ISC License", "The ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "Zlib": ["zlib License", "The zlib License"],
}

#: (licence, short notice); several notices may name one licence.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at\n"
                   "http://www.apache.org/licenses/LICENSE-2.0\n"
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                   "See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
]

#: Equivalent spellings: (variant, form that counts), as whole words after
#: case and punctuation have been normalised.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"),
    ("wilful", "willful"), ("whilst", "while"), ("noncommercial", "non commercial"), ("https", "http"), ("v 2 0", "version 2 0"),
]

#: Licences that an SPDX line can name, beside those of ``NOTICES``.
SPDX = (
    "0BSD Artistic-1.0-Perl Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 "
    "CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 ISC MIT-0 MPL-1.1 MPL-2.0 PSF-2.0 Unlicense WTFPL Zlib").split()
#: Those that an SPDX line names as they stand, with -only or with -or-later.
SPDX_GNU = "AGPL-3.0 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0".split()
#: Where the terms end and advice on applying them begins.
_ENDS = "END OF TERMS AND CONDITIONS"


def more_texts() -> list[tuple[str, str]]:
    """(licence, text) of the long licences, also without what follows their terms, and of SPDX lines."""
    out = [(x, f"SPDX-License-Identifier: {x}") for x in SPDX]
    out += [(x, f"SPDX-License-Identifier: {x}{end}") for x in SPDX_GNU for end in ("", "-only", "-or-later", "+")]
    for path in sorted((Path(__file__).parent / "texts").glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        out.append((path.stem, text))
        if _ENDS in text:
            terms = text[:text.rindex(_ENDS)]
            out += [(path.stem, terms), (path.stem, terms + _ENDS)]
    return out
