"""Digests of full licence texts and usual file headers, of the normal form of `licences`; equal names are wordings in use.

A changed normal form needs them anew: md5 of the normal form of the published text, line feeds as spaces.
"""

DIGESTS = {
    "Apache-2.0": (
        "2ae115b53440246355f1d53f38dd56f2",
        "7c8783a7d71e381e60513a646f6526d7",
        "8f004e1a1666b89f210cfd49e9130099",
        "a9a9b90e689d37bffb3d4e0607c983db",
        "ad08bc19e123883536d3a91ca0dc5793",
        "b2ff560406f5418bd3f02e38ebca6f32",
        "be34bab364b042c924b864beb579f221",
        "eeab5bd8322709a50be1485079dacc25",
        "f6a849eb9abaf7c79e1dae96c328d5f4",
    ),
    "Apache-2.0 WITH LLVM-exception": (
        "e088a9ea9321c62a51982bf483cea1f8",
    ),
    "Artistic-1.0-Perl": (
        "01297679267ad921516667ccd889865e",
    ),
    "BSD-3-Clause": (
        "c245a9d439da9a8ea626ab19c280d998",
        "ddcd765ed0a3236bf96e15f76c36983a",
    ),
    "CC-BY-SA-4.0": (
        "b51a46a03c974a82c2f7425a740d6499",
    ),
    "CC0-1.0": (
        "93a180096f6cfcf2c0dd24f75c2eec48",
    ),
    "GFDL-1.2": (
        "c969fdb4b731dadf7173c1ffbe49a117",
    ),
    "GFDL-1.3": (
        "eb6b86c0fad89753a5a36c484fa0ada2",
    ),
    "GPL-1.0": (
        "463097dfc19f461d3924fe8bef1b8254",
        "738cc3b112640d95d4cd79a58967ecea",
    ),
    "GPL-2.0": (
        "2f4019a210bf7d2de60fa08bc5768bfc",
        "5e39ace6e62f5a7fe9c17b4da986ad8c",
        "a731e56684fe9202ad8f1df5be3645ef",
        "bb7e7527c861092329f5ca43b688d331",
        "e0b7635c5df0abca544f6e8bbe326fde",
        "e59908d360486cb0fc4b01e63b225f52",
    ),
    "GPL-3.0": (
        "5eaa767cc0a56c87c3852144458a3bf1",
        "b26cb9c7d122ecf292549e3c1aff4409",
        "cbcd0971278be25219f37b6486dcbe3f",
    ),
    "LGPL-2.0": (
        "74cf7fcef3b29a39165a795b2cad3a3a",
        "9816cfd507cb536e4957f3145a09f582",
        "b2b2c7dac31c74d81c1f4d8da1f08e0b",
    ),
    "LGPL-2.1": (
        "35149cc0147209ad0af2abd9b7190399",
        "59e61b2218823463b19c0a5d3e9e4412",
        "f998bc436710cfece156aaa84fd26dd4",
    ),
    "LGPL-3.0": (
        "b31b7335bc37919e8cdd79154e04d88d",
    ),
    "MIT": (
        "5fefeb84c2e262528a30c16c8f8d7a34",
        "66dd1caf442553ce09fa72a9da2e8c0e",
        "87da029a979185feb91a6830e1ade1e9",
    ),
    "MPL-1.1": (
        "9cdb0c94cb45abb55c616e067859d4ad",
    ),
    "MPL-2.0": (
        "db12a21e89062c14ac06f7d6aa8123d5",
    ),
    "Unicode-3.0": (
        "54046d17efe4d32144d4f78efeafa3d0",
    ),
    "Unlicense": (
        "243d95b52f77dc596a0b9d0b9ba09bb5",
    ),
}
