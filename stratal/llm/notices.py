"""Public licence notices: whole texts, standard headers, titles and names.

A bounded table of fixed wording. Licence texts longer than a page (Apache,
GPL, LGPL, AGPL, MPL, Creative Commons) are covered by their title, their
standard header and their usual names, not by their full text.
"""

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:")
_BSD_1 = ("Redistributions of source code must retain the above copyright notice, this list of conditions and the "
          "following disclaimer.")
_BSD_2 = ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
          "following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_3 = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission.")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction")
_MIT_RIGHTS = (", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
               "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so")
_MIT_NOTICE = (", subject to the following conditions: The above copyright notice and this permission notice shall be "
               "included in all copies or substantial portions of the Software.")
_MIT_END = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means.")
_UNLICENSE_REST = (
    " In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the "
    "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of "
    "all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY "
    "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE. For more information, please refer to https://unlicense.org")
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
    "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.")
_MPL = (" If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")


def _gnu(kind: str, version: str) -> tuple[str, ...]:
    """Names, title and standard header of a GNU licence."""
    dates = {"GPL-2": "June 1991", "GPL-3": "29 June 2007", "LGPL-2.1": "February 1999", "LGPL-3": "29 June 2007",
             "AGPL-3": "19 November 2007"}
    short = {"": "GPL", "Lesser ": "LGPL", "Affero ": "AGPL"}[kind]
    name = f"GNU {kind}General Public License"
    header = (f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as "
              f"published by the Free Software Foundation, either version {version} of the License")
    later = ", or (at your option) any later version."
    end = (f" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
           f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.")
    return (f"{name}, version {version}", f"{name} Version {version}, {dates[f'{short}-{version}']}",
            f"version {version} of the {name}", f"{header}{later}", f"{header}{later}{end}", f"{header}.",
            f"{short} version {version} license", f"{short} {version} license", f"GNU {short} version {version}",
            f"GNU {short} {version}", f"{name} {version}",
            f"under the terms of the {name} version {version} as published by the Free Software Foundation",
            f"{short}v{version} license", f"Licensed under {short}v{version}", f"Licensed under {short} v{version}",
            f"Licensed under {short} v{version} or later", f"Licensed under the {short} v{version} or later")


def _cc(letters: str, words: str) -> tuple[str, ...]:
    return (f"CC {letters} 4.0", f"Creative Commons {words} 4.0", f"Creative Commons {words} 4.0 International Public License",
            f"This work is licensed under a Creative Commons {words} 4.0 International License.")


# Licence and its texts besides the ones of ``licenses.TEMPLATES``; of texts within texts the longest found
# is returned. BSD texts stand without their clause numbers.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache License Version 2.0, January 2004", _APACHE),
    "MIT": ("MIT License", "The MIT License (MIT)"),
    "MIT-text": (_MIT + _MIT_RIGHTS + _MIT_NOTICE + _MIT_END, _MIT + _MIT_RIGHTS + _MIT_NOTICE),
    "MIT-0": ("MIT No Attribution", _MIT + _MIT_RIGHTS + "." + _MIT_END),
    "BSD-2-Clause": (f"{_BSD} {_BSD_1} {_BSD_2} {_BSD_END}", f"{_BSD} {_BSD_1} {_BSD_2}", "BSD 2-Clause License",
                     "Simplified BSD License"),
    "BSD-3-Clause": (f"{_BSD} {_BSD_1} {_BSD_2} {_BSD_3}", "BSD 3-Clause License", "New BSD License", "Revised BSD License"),
    "BSD": (_BSD,),  # the opening alone does not tell the clauses
    "ISC": (_ISC + _ISC_NOTICE + _ISC_END, _ISC + _ISC_NOTICE, "ISC License"),
    "0BSD": (_ISC + "." + _ISC_END,),
    "Unlicense": (_UNLICENSE, _UNLICENSE + _UNLICENSE_REST, "The Unlicense", "Unlicense License"),
    "GPL-2.0": _gnu("", "2"),
    "GPL-3.0": _gnu("", "3"),
    "LGPL-2.1": _gnu("Lesser ", "2.1"),
    "LGPL-3.0": _gnu("Lesser ", "3"),
    "AGPL-3.0": _gnu("Affero ", "3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0." + _MPL),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0", "Creative Commons CC0 1.0 Universal License",
                "Creative Commons Zero v1.0 Universal",
                "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work under the CC0 1.0 Universal Public Domain Dedication"),
    "CC-BY-4.0": _cc("BY", "Attribution"),
    "CC-BY-SA-4.0": _cc("BY-SA", "Attribution-ShareAlike"),
    "CC-BY-ND-4.0": _cc("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-4.0": _cc("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-SA-4.0": _cc("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _cc("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
}
#: SPDX lines and short declarations: the name of the licence as declared.
for _name in [n for n in NOTICES if n not in ("MIT-text", "BSD")]:
    NOTICES[_name] += (f"SPDX-License-Identifier: {_name}", f"License: {_name}")
#: Ids that declare a licence by themselves, in an expression or with their version.
IDS = {_name: (_name,) for _name in ("Apache-2.0", "MIT", "MIT-0", "ISC", "0BSD", "Unlicense", "BSD-2-Clause", "BSD-3-Clause",
                                     "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0")}
for _name in ("GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "AGPL-3"):
    IDS[_name if "." in _name else _name + ".0"] += (_name.replace("-", "v"),)
BSD_3_CLAUSE = f"{_BSD} {_BSD_1} {_BSD_2} {_BSD_3} {_BSD_END}"
MIT_OPENING = _MIT
