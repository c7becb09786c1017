"""Training-data operators for text corpora (mixing, de-duplication, tokens,
licences, language models, packing, search, quality).

Nothing else in ``stellate`` imports this subpackage; it uses only general
helpers of ``stellate.session`` and ``stellate.operators``.
"""
