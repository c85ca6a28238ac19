"""Tables, message streams and adapters."""
