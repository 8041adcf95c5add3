"""Operators for training-data pipelines, each over whole tables.

========================  ==================================================================
``quality_rules``         adaptive thresholds from mergeable quantile sketches
``decontamination``       size-partitioned MinHash containment of benchmark items
``substring_dedup``       lines or paragraphs that occur earlier in the corpus
``sharding``              jump consistent hashing
``license_scan``          ordered signature rules behind a keyword prefilter
``line_dedup``            boilerplate lines by their share of a site's pages
``source_mixing``         temperature weights realised as block permutations
``chat_format``           typed content parts flattened into a chat template
``simhash_dedup``         Gray-order hierarchical index over SimHash fingerprints
``suffix_dedup``          logarithmic family of sparse suffix arrays
``byte_bpe``              byte-level BPE by backtracking over compatible neighbours
``collocations``          phrases scored from unions of weighted automata
``conversation_repair``   cheapest edits that repair the turns of a conversation
========================  ==================================================================

``queries`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel with their tasks, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
