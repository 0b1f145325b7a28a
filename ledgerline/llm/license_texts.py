"""Notices and paragraphs of well-known licenses, several under one label.

A row is (label, text, keys): ``keys`` are phrases of the text, of three words
or more and apart by ``|``, that tell the license from those of like wording;
a place in a document counts only when it holds all of them.
"""

from __future__ import annotations

_GPL = ("under the terms of the GNU {0} as published by the Free Software Foundation, either "
        "version {1}")
_GPL_LONG = ("This program is free software: you can redistribute it and/or modify it " + _GPL
             + " of the License, or (at your option) any later version")
_CC = "Creative Commons Attribution"
_KINDS = {"gpl": "General Public License", "lgpl": "Lesser General Public License",
          "agpl": "Affero General Public License"}

TEXTS = [
    # MIT
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files", ""),
    ("mit", "to deal in the Software without restriction, including without limitation the rights "
            "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so", ""),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies "
            "or substantial portions of the Software", ""),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
            "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT", "particular purpose and noninfringement"),
    ("mit", "licensed under the MIT license", "the mit license"),
    # BSD
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted", ""),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer", ""),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list "
            "of conditions and the following disclaimer in the documentation and/or other "
            "materials provided with the distribution", ""),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be "
            "used to endorse or promote products derived from this software without specific "
            "prior written permission", ""),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
            "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES "
            "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED", ""),
    # Apache
    ("apache-2", "licensed under the Apache License, Version 2.0", "apache license version 2"),
    ("apache-2", "under the terms of the Apache License, Version 2.0", "apache license version 2"),
    ("apache-2", "you may not use this file except in compliance with the License", ""),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed "
                 "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                 "CONDITIONS OF ANY KIND, either express or implied", ""),
    # GNU
    ("gpl-3", "licensed under the GNU General Public License, version 3",
     "gnu general public license version 3"),
    ("gpl-3", "under version 3 of the GNU General Public License",
     "version 3 of the gnu general public license"),
    ("gpl-3", "under the GNU General Public License v3.0", "gnu general public license v3 0"),
    ("gpl-2", "licensed under the GNU General Public License, version 2",
     "gnu general public license version 2"),
    ("gpl-2", "under version 2 of the GNU General Public License",
     "version 2 of the gnu general public license"),
    ("gpl-2", "under the GNU General Public License v2.0", "gnu general public license v2 0"),
    *[(label, text.format(_KINDS[kind], n), f"gnu {_KINDS[kind].lower()}|either version {n}")
      for label, kind, n in (("gpl-3", "gpl", "3"), ("gpl-2", "gpl", "2"), ("lgpl", "lgpl", "3"),
                             ("lgpl", "lgpl", "2.1"), ("agpl", "agpl", "3"))
      for text in (_GPL, _GPL_LONG)],
    ("lgpl", "GNU Lesser General Public License", "lesser general public"),
    ("lgpl", "GNU Library General Public License", "library general public"),
    ("agpl", "GNU Affero General Public License", "affero general public"),
    # Mozilla
    ("mpl-2", "Mozilla Public License, Version 2.0", "mozilla public license version 2"),
    ("mpl-2", "Mozilla Public License, v. 2.0", "mozilla public license v 2"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     "mozilla public license"),
    # Creative Commons
    ("cc-by", "licensed under CC BY 4.0", "cc by 4"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-nc", "licensed under CC BY-NC-SA 4.0", "cc by nc sa"),
    ("cc-by-nc", "licensed under CC BY-NC-ND 4.0", "cc by nc nd"),
    *[("cc-by", f"{_CC} {n} {kind}", f"commons attribution {n}")
      for n, kind in (("4.0", "International"), ("3.0", "Unported"), ("3.0", "License"))],
    ("cc-by", "licensed under the Creative Commons Attribution License",
     "commons attribution license"),
    ("cc-by-nc", f"{_CC} NonCommercial", "commons attribution noncommercial"),
    ("cc-by-nc", f"{_CC} Non-Commercial", "attribution non commercial"),
    ("cc-by-sa", f"{_CC} ShareAlike", "commons attribution sharealike"),
    ("cc-by-sa", f"{_CC} Share Alike", "attribution share alike"),
    ("cc0", "CC0 1.0 Universal", ""),
    # others
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted", ""),
    ("unlicense", "This is free and unencumbered software released into the public domain", ""),
]
