"""Message codecs: Connect-style JSON and registry-framed Avro."""
