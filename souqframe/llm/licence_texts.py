"""What works say about their licence: notices, short licences in full, and identifiers.

Fixed values: the wordings are those of the licences and of the usual notices. Of long licences only the
notice and the beginning are here; whole texts can be given to scan_licenses() as further templates.
"""

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
    " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
    " sublicense, and/or sell copies of the Software"
)
_MIT_REST = (
    ", and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    " The above copyright notice and this permission notice shall be included in all copies or substantial"
    " portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR"
    " IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
    " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,"
    " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR"
    " IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
    " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"
    " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR"
    " ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,"
    " DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
    " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met"
)
_BSD_TWO = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution."
)
_BSD_THIRD = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission."
)
_BSD_REST = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
    " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
    " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY"
    " DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,"
    " PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER"
    " CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
    " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
    " liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
    " software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject"
    " to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that"
    " you wrote the original software. If you use this software in a product, an acknowledgment in the product"
    " documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as"
    " such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered"
    " from any source distribution."
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
    " accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute,"
    " execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties"
    " to whom the Software is furnished to do so, all subject to the following"
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,"
    " use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
    " purpose, commercial or non-commercial, and by any means."
)


def _gnu(name: str, subject: str, version: str) -> str:
    return (
        f"{subject} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as"
        f" published by the Free Software Foundation, either version {version} of the License, or (at your option) any"
        " later version."
    )


# Label -> wordings.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0.",
    ],
    "mit": [
        _MIT_GRANT,
        _MIT_GRANT + _MIT_REST,
        "Released under the MIT License.",
        "Licensed under the MIT License.",
    ],
    "isc": [_ISC, "Licensed under the ISC License."],
    "bsd": [_BSD_GRANT, "Licensed under the BSD License."],
    "bsd-2-clause": [_BSD_GRANT + _BSD_TWO + _BSD_REST],
    "bsd-3-clause": [_BSD_GRANT + _BSD_TWO + _BSD_THIRD + _BSD_REST],
    "zlib": [_ZLIB],
    "bsl-1.0": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"
        " http://www.boost.org/LICENSE_1_0.txt)",
        _BOOST,
    ],
    "unlicense": [_UNLICENSE],
    "gpl": [
        _gnu("General Public License", "This program", "3"),
        _gnu("General Public License", "This program", "2"),
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "lgpl": [
        _gnu("Lesser General Public License", "This library", "2.1"),
        _gnu("Lesser General Public License", "This program", "3"),
        "Licensed under the GNU Lesser General Public License.",
    ],
    "agpl": [
        _gnu("Affero General Public License", "This program", "3"),
        "Licensed under the GNU Affero General Public License.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
        " 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to"
        " this work.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
}

# Identifiers behind "SPDX-License-Identifier:", and the labels above that they stand for.
IDENTIFIERS = {
    "Apache-2.0": "apache-2.0", "MIT": "mit", "ISC": "isc", "BSD-2-Clause": "bsd-2-clause",
    "BSD-3-Clause": "bsd-3-clause", "Zlib": "zlib", "BSL-1.0": "bsl-1.0", "Unlicense": "unlicense",
    "GPL-2.0-only": "gpl", "GPL-2.0-or-later": "gpl", "GPL-3.0-only": "gpl", "GPL-3.0-or-later": "gpl",
    "LGPL-2.1-only": "lgpl", "LGPL-2.1-or-later": "lgpl", "LGPL-3.0-only": "lgpl", "LGPL-3.0-or-later": "lgpl",
    "AGPL-3.0-only": "agpl", "AGPL-3.0-or-later": "agpl", "MPL-2.0": "mpl-2.0", "EPL-2.0": "epl-2.0",
    "CC0-1.0": "cc0-1.0", "CC-BY-4.0": "cc-by", "CC-BY-NC-4.0": "cc-by-nc", "CC-BY-SA-4.0": "cc-by-sa",
}


def all_templates() -> dict[str, list[str]]:
    """The notices and identifiers of each label."""
    whole = {label: list(texts) for label, texts in TEMPLATES.items()}
    for identifier, label in IDENTIFIERS.items():
        whole[label].append(f"SPDX-License-Identifier: {identifier}")
    return whole
