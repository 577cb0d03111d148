"""Queries of the operators and their SQL counterparts."""

from . import hostrules, huffman, hyperminhash, langid, packing, periodic, pii, quality, sharding, superkmer, \
    tokencounts, whitening, winnow

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_superkmer": superkmer.op2_superkmer,
    "op3_winnow": winnow.op3_winnow,
    "op4_langid": langid.op4_langid,
    "op5_hyperminhash": hyperminhash.op5_hyperminhash,
    "op6_quality": quality.op6_quality,
    "op7_packing": packing.op7_packing,
    "op8_huffman": huffman.op8_huffman,
    "op9_tokencounts": tokencounts.op9_tokencounts,
    "op10_hostrules": hostrules.op10_hostrules,
    "op11_whitening": whitening.op11_whitening,
    "op12_pii": pii.op12_pii,
    "op13_periodic": periodic.op13_periodic,
}
ORACLE_SQL = {
    "op1_sharding": sharding.ORACLE_SQL,
    "op2_superkmer": superkmer.ORACLE_SQL,
    "op3_winnow": winnow.ORACLE_SQL,
    "op10_hostrules": hostrules.ORACLE_SQL,
}
