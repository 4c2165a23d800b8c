"""Texts of common licenses, which headers and license files are compared with.

By identifier: notices and short forms as they stand in headers, and whole texts of
the short licenses. A parameter of the scan; longer ones can be added by the caller.
"""

from __future__ import annotations

GNU_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}"
    " General Public License as published by the Free Software Foundation, either version {version} of the"
    " License, or (at your option) any later version. This program is distributed in the hope that it will be"
    " useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
    " PARTICULAR PURPOSE. See the GNU {kind} General Public License for more details. You should have received a"
    " copy of the GNU {kind} General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
)

# The wording of the licenses.
WORDINGS = {
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3",
        "GNU Affero General Public License Version 3, 19 November 2007",
        GNU_NOTICE.format(kind="Affero", version=3),
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR'
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License.",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution. Neither the name of the copyright"
        " holder nor the names of its contributors may be used to endorse or promote products derived from this"
        " software without specific prior written permission.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0",
        "Boost Software License - Version 1.0 - August 17th, 2003",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0",
        "CC BY 4.0",
        "Creative Commons Attribution 4.0 International",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0 into the public domain",
        "Creative Commons CC0 1.0 Universal Public Domain Dedication",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "GNU General Public License Version 2, June 1991",
        "Distributed under the GPL v2",
        GNU_NOTICE.format(kind="", version=2),
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "GNU General Public License Version 3, 29 June 2007",
        "Distributed under the GPL v3",
        GNU_NOTICE.format(kind="", version=3),
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        GNU_NOTICE.format(kind="Lesser", version=2.1).replace("program", "library"),
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3",
        "GNU Lesser General Public License Version 3, 29 June 2007",
        GNU_NOTICE.format(kind="Lesser", version=3).replace("program", "library"),
    ),
    "MIT": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        ' associated documentation files (the "Software"), to deal in the Software without restriction, including'
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the"
        " following conditions: The above copyright notice and this permission notice shall be included in all"
        " copies or substantial portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ),
    "MPL-2.0": (
        "This file is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
        " binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors"
        " be held liable for any damages arising from the use of this software. Permission is granted to anyone to"
        " use this software for any purpose, including commercial applications, and to alter it and redistribute it"
        " freely, subject to the following restrictions.",
    ),
    "proprietary": ("All rights reserved",),
}


def with_tags(wordings: dict[str, tuple[str, ...]]) -> dict[str, tuple[str, ...]]:
    """Each license with its machine-readable line, in the forms that an identifier can have."""
    return {
        name: (
            *texts,
            *(f"SPDX-License-Identifier: {name}{end}" for end in _tag_ends(name)),
        )
        for name, texts in wordings.items()
    }


def _tag_ends(name: str) -> tuple[str, ...]:
    if name == "proprietary":
        return ()
    return ("", "-only", "-or-later") if "GPL" in name else ("",)


TEMPLATES = with_tags(WORDINGS)
