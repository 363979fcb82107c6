"""Training-data operators: packing, token files, mixing, quality, near-duplicates,
WARC archives, sharding, language identification, nearest neighbours, licences,
byte-level BPE, filter audits, hard negatives.

Nothing outside this subpackage imports it.
"""
