"""A stand-in for a provider: answers from a short list, and one company that is out of reach."""

from leadmill.operators import ProviderResponse, TransientProviderError

KNOWN = {"Nova Studio": ("retail", "enterprise"), "Global Widgets": ("media", "small_business")}
OUT_OF_REACH = "air inc"


class Directory:
    provider_name = "directory"

    def enrich(self, request):
        if request["company"] == OUT_OF_REACH:
            raise TransientProviderError("no line")
        industry, size = KNOWN.get(request["company"], (None, None))
        status = "enriched" if industry else "not_found"
        return ProviderResponse(industry, size, None, status, self.provider_name, industry is not None,
                                raw_payload={"asked": str(request["company"])})
