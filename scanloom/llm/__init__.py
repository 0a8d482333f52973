"""Training-data operators over text and page tables. Nothing outside this subpackage imports it."""
