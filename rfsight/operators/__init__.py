"""DataFrame to DataFrame operators, shared by the batch and the streaming flows."""
