"""The registered queries of this subpackage."""

from reelhouse.llm.bagminhash import op2_bag_minhash
from reelhouse.llm.bpe import op8_byte_bpe
from reelhouse.llm.chaining import op5_chained_passages
from reelhouse.llm.fingerprints import op3_bloom_fingerprints
from reelhouse.llm.hmm import op6_hidden_markov
from reelhouse.llm.html import op4_site_templates
from reelhouse.llm.lexical import OP13_SQL, op13_geometric_blocks
from reelhouse.llm.mixing import op7_soft_mixing
from reelhouse.llm.orcids import op11_orc_ids
from reelhouse.llm.quality import op10_weak_supervision
from reelhouse.llm.shards import op9_kd_shards
from reelhouse.llm.toxicity import op1_toxic_segments
from reelhouse.llm.whitening import op12_cholesky_whitening

QUERIES = {
    query.__name__: query
    for query in (
        op1_toxic_segments,
        op2_bag_minhash,
        op3_bloom_fingerprints,
        op4_site_templates,
        op5_chained_passages,
        op6_hidden_markov,
        op7_soft_mixing,
        op8_byte_bpe,
        op9_kd_shards,
        op10_weak_supervision,
        op11_orc_ids,
        op12_cholesky_whitening,
        op13_geometric_blocks,
    )
}

# What SQL can express, for DuckDB over the same tables.
SQL = {"op13_geometric_blocks": OP13_SQL}
