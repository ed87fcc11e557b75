"""Operators of a training-data pipeline, on text records, pages and fingerprints.

The project keeps images, class names, predictions, training histories and run reports. Where one of its records fits, an
operator uses it: the near-duplicate index works on the ``perceptual_hash`` of an image profile, WARC archives hold its scanned
files, the prefix trie its runs' epochs. The others need running text or alternating logs, which the project has
none of, and stay general: they take any frame with an id column (``path`` as everywhere in the library, or ``run``) and a text column.
"""
