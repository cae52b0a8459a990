"""Digests of known licence texts from a folder of whole texts, as the parameter file of operator 9.

    python -m homeshift.llm.license_digests /usr/share/common-licenses homeshift/llm/known_licenses.tsv

A row: name, length and first letters of the canonical text, sha-256 of it.  A licence with an appendix on how to apply
it has a row with and one without it.  The texts themselves are not kept.
"""

from __future__ import annotations

import hashlib
import os
import sys

import regex

from homeshift.llm.license_digest import SPELLINGS, START

#: File name -> SPDX name (fixed values).
NAMES = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause-UC", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
    "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}
#: Lines with which the terms end, before an appendix (fixed values).
ENDS = ["END OF TERMS AND CONDITIONS"]

_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_BSD_ONE = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
_BSD_TWO = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
_BSD_THREE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_0BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

#: Short licences that no system folder has (fixed values).
SHORT = [
    ("BSD-2-Clause", _BSD_START + _BSD_ONE + _BSD_TWO + _DISCLAIMER), ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_START + _BSD_ONE + _BSD_TWO + _DISCLAIMER),
    ("BSD-3-Clause", _BSD_START + _BSD_ONE + _BSD_TWO + _BSD_THREE + _DISCLAIMER), ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_START + _BSD_ONE + _BSD_TWO + _BSD_THREE + _DISCLAIMER),
    ("Zlib", _ZLIB), ("Unlicense", _UNLICENSE), ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org>"),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <http://unlicense.org/>"), ("0BSD", _0BSD),
]


def canonical(text: str) -> str:
    """The normal form of ``license_digest.canonical``, in Python."""
    text = text.lower()
    for a, b in SPELLINGS:
        text = text.replace(a, b)
    text = regex.sub(r"(?m)^[ \t]*(copyright|\(c\))[^\n]*$", "", text)
    return regex.sub(r"[^\p{L}\p{N}]+", "", text)


def texts(folder: str) -> list[tuple[str, str]]:
    out = []
    for file, name in NAMES.items():
        path = os.path.join(folder, file)
        if os.path.exists(path):
            whole = open(path, encoding="utf-8").read()
            out.append((name, whole))
            out += [(name, whole[: whole.index(e) + len(e)]) for e in ENDS if e in whole]
            out += [(name, whole[: whole.index(e)]) for e in ENDS if e in whole]
    return out + SHORT


def rows(folder: str) -> list[tuple[str, int, str, str]]:
    found = {(name, len(c), c[:START], hashlib.sha256(c.encode()).hexdigest()) for name, t in texts(folder) if (c := canonical(t))}
    return sorted(found)


if __name__ == "__main__":
    with open(sys.argv[2], "w", encoding="utf-8") as f:
        f.writelines("\t".join(map(str, r)) + "\n" for r in rows(sys.argv[1]))
