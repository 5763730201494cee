"""Wordings that licence scans look for: public licence texts, notices and one-line references."""

from __future__ import annotations

# Phrases and their labels.
PHRASES: list[tuple[str, str]] = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Public wordings and their labels; a label may have several.
TEMPLATES: list[tuple[str, str]] = [
    ("mit-text", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("mit-notice", "Released under the MIT License"),
    ("mit-notice", "Licensed under the MIT License"),
    ("bsd-text", """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. Redistributions in binary
form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution."""),
    ("isc-text", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies."""),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("apache-text", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at. Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License."""),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-text", """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License,
or (at your option) any later version. This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("mpl-notice", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at"""),
    ("cc-notice", "Licensed under CC BY 4.0"),
    ("cc-notice", "Licensed under CC BY-SA 4.0"),
    ("cc-noncommercial", "Licensed under CC BY-NC 4.0"),
    ("cc-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense-text", """
This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
]
