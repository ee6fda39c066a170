"""Wording of public licences and of the notices that name them, with template markup (see ``licenses``).

Labels are the lower-case names that licence lists use. A label may have several templates.
"""

from __future__ import annotations

_UNDER = '<<var;name="verb";match="licensed|released|distributed|published|available|provided">> under <<beginOptional>>the terms of<<endOptional>> '
_AS_IS = ('provided by <<var;name="provider";words="1-20">> as is and any express or implied warranties including but not limited to the implied warranties of '
          "merchantability and fitness for a particular purpose are disclaimed in no event shall ")
_BSD_END = (
    "be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or "
    "services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort "
    "including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")
_BSD_START = (
    "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "<<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "<<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution ")

#: (label, markup)
TEMPLATES: list[tuple[str, str]] = [
    ("mit", _UNDER + "the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("apache-2.0", _UNDER + 'the Apache License <<var;name="version";match="Version 2.0|2.0|v2.0">>'),
    ("gpl-2.0", _UNDER + 'the GNU General Public License <<beginOptional>>GPL<<endOptional>> <<var;name="version";match="version 2|v2">>'),
    ("gpl-3.0", _UNDER + 'the GNU General Public License <<beginOptional>>GPL<<endOptional>> <<var;name="version";match="version 3|v3">>'),
    ("lgpl-2.1", _UNDER + 'the GNU Lesser General Public License <<beginOptional>>LGPL<<endOptional>> <<var;name="version";match="version 2.1|v2.1">>'),
    ("lgpl-3.0", _UNDER + 'the GNU Lesser General Public License <<beginOptional>>LGPL<<endOptional>> <<var;name="version";match="version 3|v3">>'),
    ("agpl-3.0", _UNDER + 'the GNU Affero General Public License <<beginOptional>>AGPL<<endOptional>> <<var;name="version";match="version 3|v3">>'),
    ("mpl-2.0", _UNDER + 'the Mozilla Public License <<var;name="version";match="Version 2.0|2.0|v2.0">>'),
    *[(f"cc-{kind}-4.0", _UNDER + f'<<beginOptional>>a<<endOptional>> <<var;name="name";match="CC|Creative Commons">> {kind.replace("-", " ")} 4.0')
      for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")],
    ("cc-by-4.0", _UNDER + "<<beginOptional>>a<<endOptional>> Creative Commons Attribution 4.0 International <<beginOptional>>Public<<endOptional>> License"),
    ("cc-by-nc-4.0", _UNDER + "<<beginOptional>>a<<endOptional>> Creative Commons Attribution NonCommercial 4.0 International <<beginOptional>>Public<<endOptional>> License"),
    ("cc-by-sa-4.0", _UNDER + "<<beginOptional>>a<<endOptional>> Creative Commons Attribution ShareAlike 4.0 International <<beginOptional>>Public<<endOptional>> License"),
    ("mit", (
        'Permission is hereby granted free of charge to any person obtaining a copy of <<var;name="software";words="1-12">> to deal in the Software without '
        "restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the Software and to "
        "permit persons to whom the Software is furnished to do so subject to the following conditions The above copyright notice and this permission notice "
        "<<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or substantial portions of the Software THE SOFTWARE IS "
        "PROVIDED AS IS WITHOUT WARRANTY OF ANY KIND EXPRESS OR IMPLIED INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY FITNESS FOR A PARTICULAR "
        'PURPOSE AND NONINFRINGEMENT IN NO EVENT SHALL <<var;name="holder";words="1-20">> BE LIABLE FOR ANY CLAIM DAMAGES OR OTHER LIABILITY WHETHER IN AN ACTION '
        "OF CONTRACT TORT OR OTHERWISE ARISING FROM OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE")),
    ("bsd-2-clause", _BSD_START + "this software is " + _AS_IS + '<<var;name="holder";words="1-20">> ' + _BSD_END),
    ("bsd-3-clause", _BSD_START + (
        '<<beginOptional>>3<<endOptional>> Neither the name of <<var;name="organisation";words="1-20">> nor the names of its contributors may be used to endorse or '
        "promote products derived from this software without specific prior written permission this software is ") + _AS_IS + '<<var;name="holder";words="1-20">> ' + _BSD_END),
    ("isc", (
        "Permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright "
        'notice and this permission notice appear in all copies THE SOFTWARE IS PROVIDED AS IS AND <<var;name="author";words="1-12">> DISCLAIMS ALL WARRANTIES WITH '
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS")),
    ("apache-2.0", (
        'Licensed under the Apache License Version 2.0 the License you may not use this <<var;name="thing";words="1-4">> except in compliance with the License You '
        "may obtain a copy of the License at <<beginOptional>>http www.apache.org/licenses/LICENSE-2.0<<endOptional>> <<beginOptional>>https www.apache.org/licenses/LICENSE-2.0"
        "<<endOptional>> Unless required by applicable law or agreed to in writing software distributed under the License is distributed on an AS IS BASIS WITHOUT WARRANTIES "
        "OR CONDITIONS OF ANY KIND either express or implied See the License for the specific language governing permissions and limitations under the License")),
    ("gpl-2.0-or-later", (
        '<<var;name="program";match="This program|This file|This library">> is free software you can redistribute it and/or modify it under the terms of the GNU '
        'General Public License as published by the Free Software Foundation either version 2 of the License or <<beginOptional>>at your option<<endOptional>> any later version')),
    ("gpl-3.0-or-later", (
        '<<var;name="program";match="This program|This file|This library">> is free software you can redistribute it and/or modify it under the terms of the GNU '
        'General Public License as published by the Free Software Foundation either version 3 of the License or <<beginOptional>>at your option<<endOptional>> any later version')),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain Anyone is free to copy modify publish use compile sell or distribute this software"),
    ("zlib", (
        "This software is provided as-is without any express or implied warranty In no event will the authors be held liable for any damages arising from the use of "
        "this software Permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely")),
]
