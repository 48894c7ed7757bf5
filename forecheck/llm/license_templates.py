"""Licence templates (fixed values: public notices, headers and whole texts).

``DISTINCT`` names per notice or header the phrases that name its licence and version:
each must stand, word by word, inside the matched span. A phrase of ``TITLES`` must do
so only where the match reaches the title, so a whole text without its title is
still found. Whole texts have no such phrases: where several match, the better
alignment wins. ``FOREIGN`` names phrases of licences whose whole texts are not among
the templates; a match whose span holds one is not of the template.
"""

from forecheck.llm.license_texts import TEXTS

TEMPLATES: dict[str, str] = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software.""",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License.""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software Foundation, either version 3
of the License, or (at your option) any later version. This program is distributed in the hope that it
will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: Redistributions of source code must retain
the above copyright notice, this list of conditions and the following disclaimer. Redistributions in
binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is
free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC0-notice": "Released into the public domain under CC0 1.0.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "Unlicense-text": """This is free and unencumbered software released into the public domain. Anyone is
free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In
jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and
all copyright interest in the software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and successors. We intend this dedication to
be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    **TEXTS,
}

DISTINCT: dict[str, tuple[str, ...]] = {
    "MIT-notice": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0",),
    "Apache-2.0-notice": ("Apache License, Version 2.0",),
    "MPL-2.0": ("Mozilla Public License, v. 2.0",),
    "CC0-notice": ("CC0 1.0",),
    "LGPL-3.0-text": ("GNU Lesser General Public License",),
}

FOREIGN: dict[str, tuple[str, ...]] = {
    "GPL-3.0-text": ("Remote Network Interaction",),
}

TITLES: dict[str, str] = {
    "Apache-2.0-text": "Apache License Version 2.0, January 2004",
    "CC0-1.0-text": "CC0 1.0 Universal",
    "GPL-1.0-text": "GNU GENERAL PUBLIC LICENSE Version 1, February 1989",
    "GPL-2.0-text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0-text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.0-text": "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    "LGPL-2.1-text": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0-text": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "MPL-1.1-text": "MOZILLA PUBLIC LICENSE Version 1.1",
    "MPL-2.0-text": "Mozilla Public License Version 2.0",
}


def _add(name: str, text: str, *phrases: str) -> None:
    TEMPLATES[name] = text
    DISTINCT[name] = phrases


# GNU licences: one-line notices and the header of source files, per version
for _short, _long, _versions in (
        ("GPL", "GNU General Public License", ("1", "2", "3")),
        ("LGPL", "GNU Library General Public License", ("2",)),
        ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
        ("AGPL", "GNU Affero General Public License", ("3",))):
    for _v in _versions:
        _id = f"{_short}-{_v}" if "." in _v else f"{_short}-{_v}.0"
        _add(f"{_id}-notice", f"This work is licensed under the {_long}, version {_v}.",
             f"the {_long}, version {_v}")
        _add(_id, TEMPLATES["GPL-3.0"].replace("GNU General Public License", _long)
             .replace("version 3", f"version {_v}"), f"terms of the {_long}", f"either version {_v}")

# Creative Commons: the short and the long name of every variant and version
_LONG = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _v, _port in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"),
                      ("4.0", "International")):
        _add(f"CC-{_kind}-{_v}-notice", f"Licensed under CC {_kind} {_v}.", f"CC {_kind} {_v}")
        _full = "Creative Commons " + "-".join(_LONG[k] for k in _kind.split("-"))
        if _v < "4.0":
            _full = _full.replace("NoDerivatives", "NoDerivs")
        _add(f"CC-{_kind}-{_v}-long-notice", f"This work is licensed under a {_full} {_v} {_port} License.",
             f"{_full} {_v}")

# BSD: whole texts and one-line notices; two clauses run on into the disclaimer,
# three clauses hold the one about names
_AS_IS = """ THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NAMES = """ Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission."""
_add("BSD-2-Clause-text", TEMPLATES["BSD"] + _AS_IS)
_add("BSD-3-Clause-text", TEMPLATES["BSD"] + _NAMES + _AS_IS)
_add("BSD-notice", "Released under the BSD License.", "BSD License")
for _n in "234":
    _add(f"BSD-{_n}-Clause-notice", f"Released under the BSD {_n}-Clause License.", f"BSD {_n}-Clause")
_add("ISC-notice", "Released under the ISC License.", "ISC License")
for _v in ("1.0", "1.1"):
    _add(f"Apache-{_v}-notice", f"Licensed under the Apache License, Version {_v}.",
         f"Apache License, Version {_v}")
for _v in ("1.0", "1.1", "2.0"):
    _add(f"MPL-{_v}-notice", f"Licensed under the Mozilla Public License, Version {_v}.",
         f"Mozilla Public License, Version {_v}")
