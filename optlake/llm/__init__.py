"""Training-data operators: near-dedup, personal data, language-model scores,
toxicity, URL templates, byte-pair encoding, licences, decontamination, exact
top-k search and chat formatting.  Nothing outside this package imports it.
"""
